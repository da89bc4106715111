"""Delimited-file and Parquet sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalise_header
from ..session import COMPRESSION

# The text cells pandas' read_csv treats as missing by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: a null cell of the files that this library writes, so that a text
# such as None or NA, or an empty one, stays what it is.
NULL_TOKEN = "\\N"
_LINE = "_corrupt_record"
FAULTS = "array<struct<column:string,value:string,reason:string>>"


def _csv(spark: SparkSession, header: bool, sep: str, multi_line: bool):
    """Quoted cells as pandas writes them: quotes doubled; line breaks inside a
    cell need ``multi_line`` (a file is then read by one task)."""
    return (spark.read.option("header", header).option("sep", sep).option("quote", '"')
            .option("escape", '"').option("multiLine", multi_line))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = ",", header: bool = True,
                   na_tokens: list[str] | None = PANDAS_NA_TOKENS, multi_line: bool = False) -> DataFrame:
    """Read every cell as text, turn missing-value tokens into null, then
    convert to ``schema`` with ``try_cast`` (bad cells become null, no failure).

    With a header the schema's names must be the file's, compared after the
    header rule (lower case, underscores), in the same order. Without a schema
    the columns stay strings; see ``read_csv_inferred``.
    """
    raw = _csv(spark, header, sep, multi_line).option("inferSchema", False).csv(path)
    tokens = na_tokens or []
    cols = []
    for name in raw.columns:
        c = F.col(f"`{name}`")
        if tokens:
            c = F.when(c.isin(tokens), F.lit(None)).otherwise(c)
        cols.append(c.alias(name))
    df = raw.select(*cols)
    if schema is None:
        return df
    if len(schema.fields) != len(df.columns):
        raise ValueError(f"schema has {len(schema.fields)} fields, file has {len(df.columns)}")
    if header:
        have, want = [normalise_header(c) for c in df.columns], [normalise_header(c) for c in schema.names]
        if have != want:
            raise ValueError(f"header {have} is not {want}")
    return df.select(*[F.col(f"`{src}`").try_cast(f.dataType).alias(f.name)
                       for src, f in zip(df.columns, schema.fields)])


def read_cells(spark: SparkSession, path: str, names: list[str], sep: str = ",", header: bool = True,
               multi_line: bool = False, null_token: str = "") -> DataFrame:
    """All cells as text under ``names`` (null: an empty cell or ``null_token``), and in ``_corrupt_record`` the line of a row
    that has another number of cells. A header must have the names (see ``read_delimited``)."""
    reader = _csv(spark, header, sep, multi_line)
    if header:
        have, want = [[normalise_header(c) for c in cols] for cols in (reader.csv(path).columns, names)]
        if have != want:
            raise ValueError(f"header {have} is not {want}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _LINE]])
    return reader.option("nullValue", null_token).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).schema(schema).csv(path)


def checked_cells(text: DataFrame, schema: T.StructType, required: list[str] | None = None,
                  na_tokens: list[str] | None = PANDAS_NA_TOKENS) -> DataFrame:
    """Text cells converted to ``schema``, with ``raw`` (the cells as they came) and
    ``faults``: per bad cell its column, text and reason. A cell that is no value of its
    type, a missing one in a ``required`` column, a line with another number of cells."""
    typed, found, any_bad = [], [], F.lit(False)
    for f in schema.fields:
        cell = F.col(f"`{f.name}`")
        if na_tokens:
            cell = F.when(~cell.isin(na_tokens), cell)
        value = cell.try_cast(f.dataType)
        typed.append(value.alias(f.name))

        def fault(text: Column, reason: str, name: str = f.name) -> Column:
            return F.struct(F.lit(name).alias("column"), text.cast("string").alias("value"), F.lit(reason).alias("reason"))

        bad = F.when(cell.isNotNull() & value.isNull(), fault(cell, f"not a {f.dataType.simpleString()}"))
        if f.name in (required or []):
            bad = bad.when(cell.isNull(), fault(F.lit(None), "missing"))
        found.append(bad)
        any_bad = any_bad | (value.isNull() if f.name in (required or []) else cell.isNotNull() & value.isNull())
    # a filter of arrays is not compiled, so only the rows that have a fault come to it
    faults = F.when(any_bad, F.filter(F.array(*found), lambda x: x.isNotNull()).cast(FAULTS)).otherwise(F.array().cast(FAULTS))
    if _LINE in text.columns:
        line = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col(_LINE).alias("value"),
                                F.lit("number of cells").alias("reason"))).cast(FAULTS)
        faults = F.when(F.col(_LINE).isNotNull(), line).otherwise(faults)
    raw = F.array(*[F.col(f"`{c}`") for c in schema.names])
    return text.select(*typed, raw.alias("raw"), faults.alias("faults"))


def write_checked(checked: DataFrame, path: str) -> None:
    """Good and rejected rows in one pass, each in a folder of its own; the cells as
    they came are kept with the rejects."""
    rejected = F.size("faults") > 0
    (checked.withColumn("rejected", rejected).withColumn("raw", F.when(rejected, F.col("raw")))
     .write.mode("overwrite").option("compression", COMPRESSION).partitionBy("rejected").parquet(path))


def good_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows without a fault."""
    return _written(spark, path, schema).where(~F.col("rejected")).select(*schema.names)


def rejected_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rejects: (column, value, reason, raw), one row per fault."""
    rows = _written(spark, path, schema).where(F.col("rejected"))
    return rows.select("raw", F.explode("faults").alias("f")).select("f.*", "raw")


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType(list(schema.fields) + [T.StructField("raw", T.ArrayType(T.StringType())),
                                                T.StructField("faults", T._parse_datatype_string(FAULTS)),
                                                T.StructField("rejected", T.BooleanType())])
    return spark.read.schema(whole).parquet(path)


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header + ``inferSchema`` (an extra pass over the file)."""
    return _csv(spark, True, ",", multi_line).option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
