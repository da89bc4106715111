"""Distinct and survivor selection.

All forms are hash aggregations, so Spark combines map-side before the
shuffle: a key holding a third of the rows reaches the reducers as one partial
row per map task, not as a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT cols``."""
    cols = cols or df.columns
    return df.select(*cols).distinct()   # planned as a partial + final hash aggregate


def survivor(df: DataFrame, key: list[str], prefer: list[Column]) -> DataFrame:
    """One row per key: the smallest by ``prefer`` then by every other
    column (deterministic, unlike ``dropDuplicates(subset)``).

    ``prefer`` are sort expressions without nulls, e.g. ``F.col('id').isNull()``
    so that rows carrying a database id win over file rows.
    """
    payload = [c for c in df.columns if c not in key]
    pri = [p.alias(f"__p{i}") for i, p in enumerate(prefer)]
    best = F.min(F.struct(*pri, *[F.col(c) for c in payload])).alias("__best")
    return (df.groupBy(*key).agg(best)
              .select(*key, *[F.col(f"__best.{c}").alias(c) for c in payload])
              .select(*df.columns))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier identical row."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long")
                       .alias("duplicate_rows"))
