"""Profiling of a table (E1-E6), each in one job over the data.

Per-column statistics go through a long (column, value) form: one
``groupBy(column, value)`` with map-side combine serves distinct counts and
value counts for all columns at once, instead of one job per column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import duplicate_count  # noqa: F401  (E6 lives with the other dedup forms)


def _quoted(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def long_form(df: DataFrame) -> DataFrame:
    """(column, value) with every value as text; nulls kept as null."""
    cols = [F.col(f"`{c}`").cast("string") for c in df.columns]
    wide = df.select(*[c.alias(n) for c, n in zip(cols, df.columns)])
    return wide.unpivot([], _quoted(df), "column", "value")


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"))


def schema_rows(df: DataFrame) -> DataFrame:
    """(position, column, type) of every column (metadata, no scan)."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, null_count) from a single aggregate pass."""
    one = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in df.columns])
    return one.unpivot([], _quoted(one), "column", "null_count").select(
        "column", F.coalesce(F.col("null_count"), F.lit(0)).cast("long").alias("null_count"))


def value_counts(df: DataFrame) -> DataFrame:
    """E5: (column, value, count) for every column, nulls excluded."""
    return (long_form(df).filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column, distinct_count), nulls excluded; a column of nulls only has 0."""
    per = long_form(df).groupBy("column", "value").agg(F.lit(1).alias("one"))
    found = per.groupBy(F.col("column").alias("c")).agg(F.count("value").alias("n"))
    every = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    return every.join(found, F.col("column") == F.col("c"), "left").select(
        "column", F.coalesce("n", F.lit(0)).cast("long").alias("distinct_count"))


def distinct_sketches(df: DataFrame, by: list[str] | None = None, lg_k: int = 14) -> DataFrame:
    """E4, approximate: a HyperLogLog sketch per column (and group): one row of binary
    columns named like the columns. Each task sends its sketches, never a value;
    sketches of parts (days, batches) can be kept and merged (``merged_sketches``)."""
    of = [c for c in df.columns if c not in (by or [])]
    return df.groupBy(*(by or [])).agg(*[F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), lg_k).alias(c) for c in of])


def merged_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One sketch per column (and group) out of the sketches of parts."""
    of = [c for c in sketches.columns if c not in (by or [])]
    return sketches.groupBy(*(by or [])).agg(*[F.hll_union_agg(f"`{c}`").alias(c) for c in of])


def sketch_error(lg_k: int = 14) -> float:
    """Three standard errors of a merged sketch with 2**lg_k registers."""
    return 3 * 1.04 / math.sqrt(2 ** lg_k)


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(column, distinct_estimate) of one row of sketches; nulls are not counted."""
    each = sketches.select(*[F.hll_sketch_estimate(f"`{c}`").cast("long").alias(c) for c in sketches.columns])
    return each.unpivot([], _quoted(each), "column", "distinct_estimate")


def top_values(df: DataFrame, n: int, support: float = 0.001) -> DataFrame:
    """E5, most frequent first: (column, value, count, rank) of the ``n`` most
    frequent values per column, equal counts by value; exact.

    A frequent-items summary of at most 1 / support values per column names every
    value that more than ``support`` of the rows have; one more pass counts the
    named values. A column is done if these are all its values, or if its n-th
    count is above what any unnamed value can have. Only the other columns (no
    frequent values) go through full value counts, whose ranks are cut before the
    shuffle (``row_number() <= n`` is a limit per task and group)."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    plain = text.toDF(*[f"c{i}" for i in range(len(text.columns))])
    named = plain.freqItems(plain.columns, support).first()
    spark = df.sparkSession
    # at most 1 / support values per column
    candidates = spark.createDataFrame([(c, v) for c, vs in zip(text.columns, named) for v in vs or [] if v is not None],
                                       "c string, v string")
    rows = long_form(text).where(F.col("value").isNotNull())
    hit = rows.join(F.broadcast(candidates), (F.col("column") == F.col("c")) & (F.col("value") == F.col("v")), "left")
    # values that are not named are one group per column
    per = hit.groupBy("column", F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("count")).collect()
    total, done = {}, []
    for r in per:
        total[r["column"]] = total.get(r["column"], 0) + r["count"]
    for c in text.columns:
        counts = sorted((r["count"] for r in per if r["column"] == c and r["value"] is not None), reverse=True)
        whole = sum(counts) == total.get(c, 0)
        if whole or (len(counts) >= n and counts[n - 1] > support * total[c]):
            done.append(c)
    known = spark.createDataFrame([tuple(r) for r in per if r["column"] in done and r["value"] is not None],
                                  "column string, value string, count long")
    rest = [c for c in df.columns if c not in done]
    if rest:
        known = known.unionByName(value_counts(df.select(*[F.col(f"`{c}`") for c in rest])))
    w = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    return known.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
