"""Packs of whole texts, and questions about names (64-bit hashes) over all packs.

``packed`` writes the documents once, a few megabytes of texts per row, bucketed
by pack, so answers can be joined to the packs without shuffling texts again.

A question has three steps. ``ask``: each pack sends its distinct names, sorted,
dealt out by name into parts (one row per pack and part, never more rows than
names). ``answer``: everything known about the names of a part meets in one
group of bounded size and goes back as one value per name, in the same order.
``told``: a pack's answers, put together in the order of its names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, delete_path
from . import words as W
from .common import prepare, shuffle_partitions

PACK_CHARS = 4 << 20
PART_BYTES = 16 << 20
#: parts that one task answers, and bytes of texts in a bucket, in parts
TASK_PARTS = 4


def new_table() -> str:
    return f"packs_{uuid.uuid4().hex}"


def drop(spark: SparkSession, table: str) -> None:
    """Remove packs that no later step reads."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    delete_path(spark, f"{checkpoint_dir(spark)}/{table}")


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           pack_chars: int = PACK_CHARS, table: str | None = None) -> tuple[DataFrame, int]:
    """(pack, ids, texts) and the number of parts to deal names into.

    A row of the input is (pack, index) from then on, whatever its id is. The
    numbers of parts and of buckets follow the bytes of the texts, which are summed
    up first (one scan of the text column). A caller that is done with the packs
    before its result is read names the ``table`` and drops it.
    """
    spark = docs.sparkSession
    prepare(spark)
    schema = "pack long, ids array<long>, texts array<string>, size long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 16) + k], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([texts], pa.list_(pa.string())), pa.array([size], pa.int64())],
                names=["pack", "ids", "texts", "size"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # a few characters for the row itself: packs of empty texts are bounded, too
                n = 16 + (len(t) if t else 0)
                if ids and size + n > pack_chars:
                    yield flush()
                    k, ids, texts, size = k + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += n
        if ids:
            yield flush()

    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    table = table or new_table()
    total = named.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    parts = max(shuffle_partitions(spark), int(total // PART_BYTES) + 1)
    (named.mapInArrow(run, schema).write.bucketBy(tasks(spark, parts), "pack")
     .option("path", f"{checkpoint_dir(spark)}/{table}").saveAsTable(table))
    return spark.table(table).select("pack", "ids", "texts"), parts


def tasks(spark: SparkSession, parts: int) -> int:
    """Buckets of packs, and tasks that share the parts: a task's bytes stay the same
    however large the tables are."""
    return max(shuffle_partitions(spark), -(-parts // TASK_PARTS))


def by_part(asked: DataFrame, parts: int) -> DataFrame:
    """Questions where their part is answered."""
    return asked.repartition(tasks(asked.sparkSession, parts), "part")


def part_of(names: np.ndarray, parts: int) -> np.ndarray:
    """The part of every name (high bits of another hash of it)."""
    return ((W.mix(names ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def dealt(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): names[order[bounds[p]:bounds[p + 1]]] belong to part p."""
    part = part_of(names, parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def deal_rows(pack: int, names: np.ndarray, parts: int, columns: dict[str, np.ndarray], types: dict) -> pa.RecordBatch | None:
    """One row (part, pack, blob per column) for every part that gets names.

    ``names`` deals (one per row of every column); the columns are sent.
    """
    order, bounds = dealt(names, parts)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return None
    arrays = [pa.array(full, pa.int32()), pa.array(np.full(len(full), pack), pa.int64())]
    for c in columns.values():
        c = np.ascontiguousarray(c[order])
        arrays.append(pa.array([c[bounds[p]:bounds[p + 1]].tobytes() for p in full], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["part", "pack", *columns])


def ask(packs: DataFrame, columns: list[str], parts: int,
        fn: Callable[..., tuple[np.ndarray, dict[str, np.ndarray]]], extra: list[str] | None = None) -> DataFrame:
    """(part, pack, columns as binary): what ``fn(ids, texts, *extra)`` asks, dealt out by name."""
    extra = extra or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c) for c in ("ids", "texts", *extra)]
            for i in range(batch.num_rows):
                names, sent = fn(*[c[i].as_py() for c in cols])
                out = deal_rows(batch.column("pack")[i].as_py(), names, parts, sent, {})
                if out is not None:
                    yield out

    schema = "part int, pack long, " + ", ".join(f"{c} binary" for c in columns)
    return packs.select("pack", "ids", "texts", *extra).mapInArrow(run, schema)


def answer(asked: DataFrame, parts: int, fn: Callable[[pd.DataFrame], list[bytes]]) -> DataFrame:
    """(pack, part, told): ``fn`` sees all rows of a part and returns one blob per row."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pack": pdf["pack"], "part": pdf["part"], "told": fn(pdf)})
    return by_part(asked, parts).groupBy("part").applyInPandas(run, "pack long, part int, told binary")


def gather(answers: DataFrame, parts: int, out: str) -> DataFrame:
    """One row per pack, dealt like the buckets of packs: its answers by part."""
    pack = f"{out}_pack"
    dealt_out = answers.select(F.col("pack").alias(pack), "part", "told").repartition(
        tasks(answers.sparkSession, parts), pack)
    return dealt_out.groupBy(pack).agg(F.collect_list(F.struct("part", "told")).alias(out))


def with_answers(packs: DataFrame, answers: DataFrame, parts: int, out: str) -> DataFrame:
    """The packs with their answers; texts stay where they are (bucketed by pack)."""
    told = gather(answers, parts, out)
    return packs.join(told.hint("shuffle_hash"), F.col("pack") == F.col(f"{out}_pack"), "left").drop(f"{out}_pack")


def told(rows: list | None, names: np.ndarray, parts: int, dtype) -> np.ndarray:
    """The answers in the order of ``names`` (those that were dealt out)."""
    order, bounds = dealt(names, parts)
    out = np.zeros(len(names), dtype)
    for r in rows or []:
        p = r["part"]
        idx = order[bounds[p]:bounds[p + 1]]
        out[idx] = np.frombuffer(r["told"], dtype)
    return out


def seen_twice(pdf: pd.DataFrame, lanes: int = 1) -> list[bytes]:
    """Per name: 1 if two packs hold it or one holds it twice (columns names, many)."""
    names = np.frombuffer(b"".join(pdf["names"]), np.uint64).reshape(-1, lanes)
    many = np.frombuffer(b"".join(pdf["many"]), np.uint8).astype(bool)
    key = np.lexsort(names.T[::-1])
    s = names[key]
    same = (s[1:] == s[:-1]).all(axis=1)
    group = np.concatenate([[0], np.cumsum(~same)])
    twice = (np.bincount(group) > 1) | (np.bincount(group, weights=many[key]) > 0)
    flags = np.empty(len(names), np.uint8)
    flags[key] = twice[group]
    ends = np.cumsum([len(m) for m in pdf["many"]])
    return [flags[e - len(m):e].tobytes() for e, m in zip(ends, pdf["many"])]
