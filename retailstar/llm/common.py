"""What the operators of this subpackage share: column names that cannot clash,
written intermediate tables, and packs of whole texts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path, shuffle_partitions
from .words import slices

_ROOT = str(Path(__file__).resolve().parents[2])


#: bytes of texts that go to a Python worker at once (a single longer row goes alone)
BATCH_BYTES = 4 << 20
#: characters that one call of a text function sees (one text at least)
SLICE_CHARS = 1 << 20
#: a Python worker gives large blocks back when they are freed; else idle workers keep
#: what their largest batch took, while those of the next stage take theirs
_FREE_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576",
                "ARROW_DEFAULT_MEMORY_POOL": "system"}
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Let Python workers started from another folder import this package, and
    bound the Arrow batches they get, unless the session has a lower bound."""
    have = spark.conf.get(_BATCH_CONF, "67108864").rstrip("bB")
    if not have.isdigit() or not 0 < int(have) <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if _ROOT not in have.split(":"):
        env["PYTHONPATH"] = f"{_ROOT}:{have}" if have else _ROOT


def lean_workers(spark: SparkSession) -> None:
    """``prepare`` for a job of many stages: Python workers give large freed blocks
    back, for some more CPU time."""
    prepare(spark)
    for name, value in _FREE_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there,
    so a lost executor repeats tasks of one step only, and values that depend
    on where a row was read (row identities) are fixed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def annotate(df: DataFrame, text_col: str, fields: dict[str, str], fn: Callable[[list], dict],
             keep: list[str]) -> DataFrame:
    """``df``'s columns ``keep`` plus the columns ``fields`` (name -> type) that
    ``fn`` computes from slices of whole texts (nulls arrive as None).

    No shuffle. Spark bounds the bytes of an Arrow batch, ``slices`` bounds what
    one call of ``fn`` sees, so memory follows the longest single text only.
    """
    prepare(df.sparkSession)
    # plain names on the way through Python: a column's own name may hold anything
    frame = df.select(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keep)], F.col(quoted(text_col)).alias("text_in"))
    schema = T.StructType(list(frame.drop("text_in").schema) + [
        T.StructField(f"f{i}", T._parse_datatype_string(t)) for i, t in enumerate(fields.values())])
    arrow = to_arrow_schema(schema)
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(n_keep).to_pylist()
            for lo, hi in slices(texts, SLICE_CHARS):
                got = fn(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [c.slice(lo, hi - lo) for c in batch.columns[:n_keep]]
                    + [pa.array(got[n], type=f.type) for n, f in zip(fields, list(arrow)[n_keep:])], schema=arrow)

    return frame.mapInArrow(run, schema).toDF(*keep, *fields)


def sha256(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).hexdigest()


def quoted(name: str) -> str:
    """A column's name as it must stand in an expression, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has (names compare without case)."""
    used = {c.lower() for f in frames for c in f.columns}
    out = name
    while out.lower() in used:
        out = f"_{out}"
    return out


def ranked(df: DataFrame, row: str, rows: int, out: str, per_bucket: int = 1_000) -> DataFrame:
    """Adds ``out`` = 0 .. n-1, a dense number of the rows in hash order of the
    unique column ``row``, without a global sort: hash buckets of about
    ``per_bucket`` rows are counted (one row per bucket), numbered within, and
    shifted by the rows of the buckets before."""
    b = fresh("bucket", df)
    d = df.withColumn(b, F.pmod(F.xxhash64(F.col(row)), F.lit(pieces(rows, per_bucket))))
    before = Window.orderBy(f"{b}_k").rowsBetween(Window.unboundedPreceding, -1)
    shift = d.groupBy(F.col(b).alias(f"{b}_k")).agg(F.count(F.lit(1)).alias(f"{b}_c")).select(
        f"{b}_k", F.coalesce(F.sum(f"{b}_c").over(before), F.lit(0)).alias(f"{b}_o"))
    d = d.withColumn(f"{b}_r", F.row_number().over(Window.partitionBy(b).orderBy(row)))
    return d.join(shift, F.col(b) == F.col(f"{b}_k")).withColumn(
        out, F.col(f"{b}_o") + F.col(f"{b}_r") - 1).select(*df.columns, out)


def pieces(rows: int, per_piece: int) -> int:
    return max(1, math.ceil(rows / per_piece))


__all__ = ["F", "annotate", "fresh", "pieces", "prepare", "quoted", "ranked", "read_documents", "sha256",
           "shuffle_partitions", "stored"]
