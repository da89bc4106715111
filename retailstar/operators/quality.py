"""Data-quality checks (Q1-Q7): each returns a DataFrame of findings, or
raises for an expectation, so checks can run inside the load."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {"==": operator.eq, ">=": operator.ge, "<=": operator.le, ">": operator.gt,
        "<": operator.lt}


class ExpectationError(AssertionError):
    pass


def expect_count(df: DataFrame, expected: int, op: str = "==", name: str = "table") -> int:
    """Q1: the row count must satisfy ``count <op> expected``."""
    n = df.count()
    if not _OPS[op](n, expected):
        raise ExpectationError(f"{name}: {n} rows, expected {op} {expected}")
    return n


def expect_columns(df: DataFrame, columns: list[str]) -> None:
    """Q2: the column list must equal ``columns`` (names and order)."""
    if list(df.columns) != list(columns):
        raise ExpectationError(f"columns {df.columns} != {columns}")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Q4: number of key values that occur more than once."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
            .agg(F.count(F.lit(1)).alias("duplicate_keys")))


def orphans_all(child: DataFrame, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Q6: (column_name, orphans) for every foreign key of ``child``: rows whose
    non-null key has no parent.

    Rows are counted per key value (combined map-side, so a hot key is one row per
    task), each key by itself, so that its counts are a pair of numbers; only these
    counts meet the parents."""
    parts = []
    for c, (parent, pk) in parents.items():
        counts = (child.select(F.col(c).cast("long").alias("value")).where(F.col("value").isNotNull())
                  .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
        known = parent.select(F.col(pk).cast("long").alias("k_value"))
        lost = counts.join(known, F.col("value") == F.col("k_value"), "left_anti")
        parts.append(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphans"))
                     .select(F.lit(c).alias("column_name"), "orphans"))
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q6 for one foreign key: (orphans)."""
    return orphans_all(child, {fk: (parent, pk)}).select("orphans")


#: buckets of row hashes that two multisets are compared by
BUCKETS = 1_024


def row_hash(cols: list[str], *before: Column) -> Column:
    """A 64-bit hash of a row. A hash passes over nulls, so which cells are null goes
    in as a text."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(*before, *[F.col(f"`{c}`") for c in cols], nulls)


def row_sums(rows: DataFrame, cols: list[str], side: str) -> DataFrame:
    """(bucket, expected_rows, actual_rows, low, high): per hash bucket, the rows of
    both sides (``side`` 1 and 0) and the difference of their sums of 128-bit row
    hashes. A sum needs no order and no row leaves its task."""
    one, two = F.col("__h1").cast("decimal(38,0)"), F.col("__h2").cast("decimal(38,0)")
    sign = F.when(F.col(side) == 1, F.lit(1)).otherwise(F.lit(-1)).cast("decimal(1,0)")
    named = rows.withColumns({"__h1": row_hash(cols), "__h2": row_hash(cols, F.lit("second"))})
    return named.groupBy(F.pmod("__h1", F.lit(BUCKETS)).alias("bucket")).agg(
        F.sum(side).alias("expected_rows"), F.sum(1 - F.col(side)).alias("actual_rows"),
        F.sum(sign * one).alias("low"), F.sum(sign * two).alias("high"))


def bag_sums(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(expected_rows, actual_rows, missing_rows, extra_rows) of two multisets.

    One pass for order-free sums of row hashes per bucket (run at once; at most
    BUCKETS rows reach the driver). If all agree that is the answer. Else the rows of
    the buckets that differ, and only these, are grouped by their values (nulls are
    equal), as 1 and -1."""
    spark, cols = expected.sparkSession, expected.columns
    both = expected.withColumn("__e", F.lit(1)).unionByName(actual.select(*[F.col(f"`{c}`") for c in cols]).withColumn("__e", F.lit(0)))
    per = row_sums(both, cols, "__e").collect()
    rows_of = [sum(r[c] for r in per) for c in ("expected_rows", "actual_rows")]
    unlike = [(r["bucket"],) for r in per if r["expected_rows"] != r["actual_rows"] or r["low"] or r["high"]]
    if not unlike:
        return spark.createDataFrame([(*rows_of, 0, 0)], "expected_rows long, actual_rows long, missing_rows long, extra_rows long")
    left = both.withColumn("__b", F.pmod(row_hash(cols), F.lit(BUCKETS))).join(
        F.broadcast(spark.createDataFrame(unlike, "__u long")), F.col("__b") == F.col("__u"))
    net = left.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum(F.col("__e") * 2 - 1).alias("__net"))
    total = lambda c: F.coalesce(F.sum(F.greatest(c, F.lit(0))), F.lit(0)).cast("long")
    return net.agg(F.lit(rows_of[0]).cast("long").alias("expected_rows"), F.lit(rows_of[1]).cast("long").alias("actual_rows"),
                   total(F.col("__net")).alias("missing_rows"), total(-F.col("__net")).alias("extra_rows"))


def bag_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Q3: multiset comparison without ordering: (missing_rows, extra_rows)."""
    return bag_sums(expected, actual).select("missing_rows", "extra_rows")


def roundtrip(flat: DataFrame, denormalised: DataFrame) -> DataFrame:
    """Q7: flat rows vs the normalised tables joined back:
    (flat_rows, roundtrip_rows, missing_rows, extra_rows)."""
    return bag_sums(flat, denormalised).select(
        F.col("expected_rows").alias("flat_rows"), F.col("actual_rows").alias("roundtrip_rows"),
        "missing_rows", "extra_rows")


def not_null_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Q5: (table_name, column_name, null_rows) for every required column, one
    pass per table."""
    parts = []
    for name, (df, cols) in tables.items():
        one = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
        parts.append(one.unpivot([], cols, "column_name", "null_rows").select(
            F.lit(name).alias("table_name"), "column_name",
            F.coalesce("null_rows", F.lit(0)).cast("long").alias("null_rows")))
    return reduce(DataFrame.unionByName, parts)
