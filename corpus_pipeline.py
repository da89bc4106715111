"""The corpus pipeline: quality rules, near copies, secrets, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and reread as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retailstar.llm import bpe, mixing, ngram_join, quality_rules, secret_scan
from retailstar.llm.common import lean_workers, read_documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned list keep (operator 8)."""
    lean_workers(spark)
    return quality_rules.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of smallest id:
    five-word shingles, similarity 0.8 or more (operator 10)."""
    lean_workers(spark)
    return ngram_join.drop_near_copies(docs, shingle=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; no document goes (operator 4)."""
    lean_workers(spark)
    return secret_scan.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as their source's target asks for (operator 6)."""
    lean_workers(spark)
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, with digests of ids and decoded text (operator 1)."""
    lean_workers(spark)
    return bpe.encode_documents(docs, ["doc_id", "source"], with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]

#: learned rules, graph components and byte-level BPE have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    lean_workers(spark)
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
