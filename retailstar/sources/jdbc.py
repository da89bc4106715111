"""JDBC sources (S3, S4, S5). Connection settings are caller-supplied.

A plain ``spark.read.jdbc(url, table)`` reads in one partition; pass
``partition_column`` with bounds to read in parallel ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict:
    opts = {"url": url}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


def read_table(spark: SparkSession, options: dict, table: str, *,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, fetchsize: int | None = 10000) -> DataFrame:
    """S3: whole-table scan; parallel when a numeric partition column is given."""
    r = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if fetchsize:
        r = r.option("fetchsize", str(fetchsize))
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound, num_partitions")
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions)))
    return r.load()


def read_query(spark: SparkSession, options: dict, query: str) -> DataFrame:
    """The result of a SQL statement run by the database."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def read_all(spark: SparkSession, options: dict, names: list[str], **kw) -> dict[str, DataFrame]:
    """Name -> lazy DataFrame for every named table (``warehouse.DB_TABLES``)."""
    return {n: read_table(spark, options, n, **kw) for n in names}
