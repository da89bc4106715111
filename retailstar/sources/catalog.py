"""Registry of named tables (S5, S8, S9) and the country reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COUNTRY_REFERENCE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("population", T.LongType(), True),
    T.StructField("region", T.StringType(), True),
])


def merge_sources(*registries: dict[str, DataFrame | None]) -> dict[str, DataFrame]:
    """Later registries win; absent (None) entries are dropped."""
    out: dict[str, DataFrame] = {}
    for r in registries:
        out.update({k: v for k, v in r.items() if v is not None})
    return out


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose every table to ``spark.sql`` as a temp view ``prefix`` + name (K9)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    return sorted(prefix + name for name in tables)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """SQL text -> distributed DataFrame (no collection to the driver)."""
    return spark.sql(text)


def list_tables(spark: SparkSession) -> DataFrame:
    """``SHOW TABLES`` as a DataFrame."""
    return spark.sql("SHOW TABLES")


def small_table(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """In-memory table with an explicit schema; ``rows=[]`` gives an empty
    table of that schema. For hand-written reference rows only."""
    return spark.createDataFrame(rows, schema)
