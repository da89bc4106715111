"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Country spellings replaced before the country lookup
# (whole-cell match). Must equal the reference's replacements.
COUNTRY_ALIASES = {
    "USA": "United States",
    "UK": "United Kingdom",
}


def clean_name(c: Column | str) -> Column:
    """``initcap(trim(x))``: spaces trimmed, words split on spaces only."""
    col = F.col(c) if isinstance(c, str) else c
    return F.initcap(F.trim(col))


def normalise_header(name: str) -> str:
    """Lower case, space -> underscore (metadata only)."""
    return name.lower().replace(" ", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_header(c) for c in df.columns])


def replace_values(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Exact whole-cell replacement in one column."""
    if not mapping:
        return df
    return df.replace(mapping, subset=[column])
