"""The corpus pipeline, stage by stage, against brute-force versions."""

import re

import corpus_pipeline as C
from pyspark.sql import functions as F

from retailstar.llm import quality_rules, secret_scan
from retailstar.llm.common import stored

from .test_bpe import sha, whole
from .test_ngram_join import brute as components_of

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    names = [n for n, _ in C.STAGES]
    assert names == ["quality", "near_copies", "secrets", "mix", "encode"]
    seen = {}
    for name, stage in C.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        seen[name] = (before.collect(), docs.collect())
        assert name == "encode" or docs.columns == columns
    # quality: what rules and base rule keep, unchanged
    rules = quality_rules.learn(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    kept = quality_rules.text_stats(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"]).where(
        quality_rules.verdict(rules)).collect()
    assert sorted(r.doc_id for r in seen["quality"][1]) == sorted(r.doc_id for r in kept)
    assert set(seen["quality"][1]) <= set(seen["quality"][0])
    # near copies: the smallest id of every component
    old, new = seen["near_copies"]
    comp = components_of([(r.doc_id, r.text) for r in old], 5, 80)
    assert sorted(r.doc_id for r in new) == sorted({c for _, _, c in comp})
    # secrets: no row goes, no span is left
    old, new = seen["secrets"]
    texts = {r.doc_id: r.text for r in old}
    assert len(new) == len(old)
    for r in new:
        assert r.text == secret_scan.masked(texts[r.doc_id], "[secret]") and r.n_chars == len(r.text)
        assert secret_scan.base_spans(r.text) == []
    # mix: whole documents near the targets
    old, new = seen["mix"]
    assert set(new) <= set(old)
    total = sum(len(WORD.findall(r.text)) for r in old)
    assert abs(sum(len(WORD.findall(r.text)) for r in new) - total) < 0.35 * total
    # encode: every row
    old, new = seen["encode"]
    want = sorted((r.doc_id, sha(",".join(map(str, whole(r.text)))), sha(r.text)) for r in old)
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in new) == want
    assert sorted(map(str, C.run(spark, SF).select("doc_id", "ids_sha256").collect())) == sorted(
        map(str, docs.select("doc_id", "ids_sha256").collect()))


def test_stages_take_empty_and_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, q__n_words int"
    odd = [(1, None, None, None, None, 1), (None, "", "en", "s", 0, 1), (2, "w " * 80, None, "s", 160, 1)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in C.STAGES:
            docs = stored(stage(spark, docs, SF), f"odd-{name}")
            assert name == "encode" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "q__n_words"]
        assert docs.count() >= 0


def test_hot_duplicates_leave_one(spark):
    docs = spark.range(600).select("id", F.lit("a b c d e f g h").alias("text")).withColumnRenamed("id", "doc_id")
    assert C.near_copies(spark, docs, SF).collect()[0].doc_id == 0
    assert C.near_copies(spark, docs, SF).count() == 1


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = docs.withColumns({"a.b": F.lit(1), "c`d": F.lit("x"), "row": F.col("doc_id"), "TEXT_in": F.lit(2.0)})
    for name, stage in C.STAGES:
        odd = stored(stage(spark, odd, SF), f"names-{name}")
        assert name == "encode" or odd.columns == [*docs.columns, "a.b", "c`d", "row", "TEXT_in"]
    assert odd.count() > 0
