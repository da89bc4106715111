"""Sinks (K1-K10). Errors are raised, never swallowed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import COMPRESSION


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", null_token: str = "",
              compression: str = "none", rows_per_file: int = 0) -> None:
    """K1: CSV with header (a folder of part files); quotes inside a cell are
    doubled, as pandas and ``read_delimited`` expect. A null is ``null_token``, by
    default an empty cell; an empty text is a pair of quotes. A compressed file, or
    one with line breaks in cells, is read by one task: ``rows_per_file`` bounds it."""
    (df.write.option("compression", compression).option("maxRecordsPerFile", rows_per_file).option("nullValue", null_token).mode(mode).option("header", True).option("sep", sep).option("quote", '"')
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, count: bool = False,
                  compression: str = COMPRESSION) -> int | None:
    """K3/K8: Parquet, the default warehouse format; ``partition_by=['year']``
    for the fact gives partition pruning on year filters. ``count=True``
    returns the number of rows written, observed during the write itself
    (no second pass over the data)."""
    obs = None
    if count:
        obs = Observation("rows_written")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"]) if obs is not None else None


def write_jdbc(df: DataFrame, options: dict, table: str, mode: str = "overwrite", *,
               batchsize: int = 10000, num_partitions: int | None = None,
               truncate: bool = False) -> None:
    """K2/K4: JDBC load with batched inserts; ``truncate`` keeps the table
    definition on overwrite; ``num_partitions`` caps concurrent connections."""
    w = (df.write.format("jdbc").options(**options).option("dbtable", table)
         .option("batchsize", str(batchsize)).option("truncate", str(truncate).lower())
         .mode(mode))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.save()


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """K5: ``INSERT INTO table SELECT ...`` into an existing catalog table
    (columns by position, as SQL INSERT does)."""
    df.write.insertInto(table, overwrite=overwrite)


def truncate_table(spark, name: str) -> None:
    """K6: empty a catalog table and keep its definition."""
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_tables(spark, names: list[str]) -> None:
    """K6: drop target tables if they exist, children (the fact) first."""
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def write_format(df: DataFrame, fmt: str, mode: str = "overwrite", **options) -> None:
    """K8: any connector by name, e.g. a warehouse connector on the classpath."""
    df.write.format(fmt).mode(mode).options(**{k: str(v) for k, v in options.items()}).save()


def export_single_file(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One file for a small report (an aggregate, never a fact table)."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """K9: ``CREATE OR REPLACE TEMP VIEW``."""
    df.createOrReplaceTempView(name)
    return df


def load_all(tables: dict[str, DataFrame], writer, order: list[str] | None = None) -> list[str]:
    """K7: write every table in order (dimensions before the fact)."""
    names = order or list(tables)
    for name in names:
        writer(tables[name], name)
    return names
