"""Clean the flat sales file and split it 80:20 into database and file parts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import COUNTRY_ALIASES, normalise_headers, replace_values
from ..operators.dedup import duplicate_count
from ..operators.split import label_split

COUNTRY_RAW = "Retailer country"


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """drop rows with a null in any of ``cols`` (all by default), written as
    ``IS NOT NULL`` filters so they reach the Parquet scan."""
    cols = cols or df.columns
    return df.filter(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in cols]))


def clean_flat(raw: DataFrame, aliases: dict | None = None) -> DataFrame:
    """Replace country aliases, drop incomplete rows, normalise headers."""
    df = replace_values(raw, COUNTRY_RAW, COUNTRY_ALIASES if aliases is None else aliases)
    return normalise_headers(drop_incomplete(df))


@dataclass
class Preprocessed:
    clean: DataFrame        # every cleaned row
    labelled: DataFrame     # clean rows + part ('file' = the 20 %, 'database' = the rest)
    duplicates: DataFrame   # one row: duplicate_rows

    @property
    def file_part(self) -> DataFrame:
        return self.labelled.filter(F.col("part") == "file").drop("part")

    @property
    def database_part(self) -> DataFrame:
        return self.labelled.filter(F.col("part") == "database").drop("part")


def preprocess(raw: DataFrame, frac: float = 0.2, seed: int = 1,
               aliases: dict | None = None) -> Preprocessed:
    clean = clean_flat(raw, aliases)
    labelled = label_split(clean, frac, seed, label="part", sample_label="file",
                           rest_label="database")
    return Preprocessed(clean, labelled, duplicate_count(clean))
