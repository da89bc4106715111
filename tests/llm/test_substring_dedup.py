"""Substring dedup (3) against a brute-force window count."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from retailstar.llm import packs, substring_dedup
from retailstar.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k:k + n]) for _, w in words for k in range(len(w) - n + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k:k + n])] > 1:
                gone.update(range(k, k + n))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()], key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(substring_dedup.query(spark, sf)) == brute(rows, 35)


@pytest.mark.parametrize("n,rounds", [(5, 1), (8, 2), (12, 3)])
def test_random_texts(spark, n, rounds):
    rnd = random.Random(n)
    vocab = ["a", "b", "ab", "éà", "日本", "x" * 40]
    base = [rnd.choice(vocab) for _ in range(400)]
    rows = []
    for i in range(60):
        s = rnd.randrange(380)
        own = [rnd.choice(vocab) + str(rnd.randrange(50)) for _ in range(rnd.randrange(40))]
        copied = base[s:s + rnd.randrange(30)]
        rows.append((i, rnd.choice([" ", "\n", "\t ", "  "]).join(own + copied + own[:5])))
    rows += [(60, None), (61, ""), (62, " \n\t "), (63, "a " * 300), (64, rows[0][1]), (0, rows[0][1]), (None, "lone words")]
    df = spark.createDataFrame([(i, t, t) for i, t in rows], "doc_id long, text string, kept_text string").repartition(5)
    assert got(substring_dedup.dedup_documents(df, window=n, rounds=rounds)) == brute(rows, n)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = substring_dedup.dedup_documents(df)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and out.count() == 0


def test_equal_windows_share_inner_symbols():
    """Symbols decided inside a repeated window are the same at both places."""
    rnd = random.Random(3)
    w = [f"w{rnd.randrange(30)}" for _ in range(60)]
    texts = [" ".join([f"p{rnd.randrange(9)}" for _ in range(k)] + w) for k in (3, 17)]
    ws = W.split(W.utf8(texts))
    sym, lo, hi = substring_dedup.recompress(ws.hashes(), ws.first, 3)
    inside = []
    for d, k in ((0, 3), (1, 17)):
        at = int(ws.first[d]) + k
        m = (lo >= at) & (hi <= at + 60)
        inside.append([(int(s), int(a) - at, int(b) - at) for s, a, b in zip(sym[m], lo[m], hi[m])])
    assert inside[0] == inside[1] and len(inside[0]) > 5


def repeated_phrases(seed):
    """Two texts that share a passage; it starts and ends in phrases said back to back,
    a different number of times in each text."""
    rnd = random.Random(seed)
    w = [f"w{rnd.randrange(12)}" for _ in range(40)]
    phrases = [[f"p{rnd.randrange(6)}" for _ in range(rnd.randrange(1, 4))] for _ in range(2)]
    texts = []
    for d in range(2):
        n, m = rnd.randrange(1, 6), rnd.randrange(1, 6)
        texts.append([f"a{d}"] * 3 + phrases[0] * n + w + phrases[1] * m + [f"z{d}"] * 3)
    return texts


@pytest.mark.parametrize("n,rounds", [(5, 1), (8, 2), (12, 3), (35, 4)])
def test_no_repeated_window_is_ruled_out(n, rounds):
    for seed in range(1500):
        texts = repeated_phrases(seed)
        p = substring_dedup.Parsed([" ".join(t) for t in texts], n, rounds)
        _, inv, count = np.unique(p.names(), return_inverse=True, return_counts=True)
        found = set(p.candidates((count > 1)[inv.ravel()]).tolist())
        where = {}
        for d, t in enumerate(texts):
            for k in range(len(t) - n + 1):
                where.setdefault(tuple(t[k:k + n]), []).append(int(p.w.first[d]) + k)
        repeats = {k for v in where.values() if len(v) > 1 for k in v}
        assert repeats <= found, seed


def test_phrases_repeated_back_to_back(spark):
    rows = [(2 * s + d, " ".join(f"{s}.{x}" for x in t)) for s in range(200) for d, t in enumerate(repeated_phrases(s))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(substring_dedup.dedup_documents(df, window=8, rounds=2)) == brute(rows, 8)


def test_long_text_hashes_do_not_depend_on_blocks():
    w = W.split([("äb cde fg " * 500).encode()])
    assert np.array_equal(w.hashes(0), w.hashes(0, block=64))


def test_dealing_and_telling_keep_the_order():
    names = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64))
    batch = packs.deal_rows(3, names, 7, {"names": names}, {})
    rows = [{"part": p, "told": b} for p, b in zip(batch.column("part").to_pylist(), batch.column("names").to_pylist())]
    assert np.array_equal(packs.told(rows, names, 7, np.uint64), names)
