"""Quality rules (8): statistics by brute force, held-out accuracy of the learned list."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailstar.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
            len(w) < 50 or 100 * len(rep) > 50 * len(w))


COLS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def stats(df):
    return sorted([tuple(r) for r in Q.text_stats(df, ["doc_id"]).select(*COLS, Q.base_failed()).collect()], key=str)


def test_statistics(spark):
    rnd = random.Random(8)
    rows = [(i, "".join(rnd.choice(["a b c", "é", "\n", " x", "日本 ", "#|", "a b c ", " ", "\x1c", "\t", "\r"])
                        for _ in range(rnd.randrange(80)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n\n \n"), (73, "x x x x"), (74, "l\nl\n l\nl"), (73, "x x x x"), (None, "w " * 60)]
    df = spark.createDataFrame([(i, t, 2) for i, t in rows], "doc_id long, text string, n_words int").repartition(4)
    assert stats(df) == sorted([(i, *brute(t)) for i, t in rows], key=str)
    assert stats(df.limit(0)) == []


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = Q.query(spark, sf).collect()
    assert sorted((r.doc_id, *r[1:6], r.base_failed) for r in rows) == sorted((i, *brute(t)) for i, t in texts.items())
    assert not any(r.kept and r.base_failed for r in rows)


def test_held_out_accuracy(spark):
    """Learned on half of the labelled documents, measured on the other half."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    rules = Q.learn(docs, labels.where(half))
    test = Q.text_stats(docs.join(labels.where(~half), "doc_id"), ["doc_id", "quality"])
    r = test.where(~Q.base_failed()).groupBy("quality").agg(F.avg(Q.verdict(rules).cast("double")).alias("kept"), F.count("*")).collect()
    kept = {x.quality: x.kept for x in r}
    assert kept[1] > 0.99 and kept[0] < 0.1


def test_covering_learns_conjunctions():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    reject = ((x[:, 0] > 0.7) & (x[:, 1] <= 0.4)) | (x[:, 2] > 0.9)
    rules = Q.learn_list(x, reject, np.arange(600) % 3 == 0, ["a", "b", "c"])
    got = np.zeros(600, bool)
    for rule in rules:
        got |= Q._covers(rule, x, ["a", "b", "c"])
    assert (got == reject).mean() > 0.97 and all(1 <= len(r) <= 4 for r in rules)


@pytest.mark.parametrize("quality", [[], [1, 1, 1], [None, 1]])
def test_without_both_classes_only_the_base_rule_decides(spark, quality):
    docs = spark.createDataFrame([(i, f"w{i} " * 3 + " ".join(f"u{k}" for k in range(60))) for i in range(3)] + [(9, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(quality)), "doc_id long, quality int")
    assert Q.learn(docs, labels) == []
    out = Q.filter_documents(docs.withColumn("q__n_words", F.lit(1)), labels)
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2] and out.columns == ["doc_id", "text", "q__n_words"]


def test_conflicting_and_repeated_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (7, 0)], "doc_id long, quality int")
    assert Q.learn(docs, labels) == []
