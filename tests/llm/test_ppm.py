"""PPM scoring (9) against a dictionary implementation with explicit exclusion."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from retailstar.llm import ppm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, order=ppm.ORDER):
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    count = Counter()
    for t in train:
        count.update(WORD.findall(lower(t)) + ["\0end"])
    n, v = sum(count.values()), len(count)
    ctx = [defaultdict(Counter) for _ in range(order + 1)]

    def symbols(t):
        b = bytes(order) + lower(t).encode()
        return [(b[p - order:p], b[p] if p < len(b) else ppm.END) for p in range(order, len(b) + 1)]

    for t in train:
        for h, s in symbols(t):
            for k in range(order + 1):
                ctx[k][h[order - k:]][s] += 1

    def code(h, s):
        out, gone = 0.0, set()
        for k in range(order, -1, -1):
            seen = {x: c for x, c in ctx[k].get(h[order - k:], {}).items() if x not in gone}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if s in seen:
                return out + math.log10(seen[s] / whole)
            out += math.log10(len(seen) / whole)
            gone |= set(seen)
        return out + math.log10(1 / (ppm.SYMBOLS - len(gone)))

    res = []
    for i, t in rows:
        w = WORD.findall(lower(t)) + ["\0end"]
        res.append((i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(w),
                    sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w),
                    sum(code(h, s) for h, s in symbols(t))))
    return sorted(res, key=lambda r: (str(r[0]), r[2], r[6]))


def check(df, rows):
    got = sorted([tuple(r) for r in df.collect()], key=lambda r: (str(r[0]), r[2], r[6]))
    want = brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(ppm.query(spark, sf), rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "AbC abc\x00é"), (4, "abc abd"), (5, "日本 日本"), (None, "x"), (4, "abc abd")]
    rows += [(i, "the cat " * (i % 5)) for i in range(10, 40)]
    df = spark.createDataFrame([(i, t, t) for i, t in rows], "doc_id long, text string, code string").repartition(3)
    check(ppm.score_documents(df), rows)


def test_no_training_documents(spark):
    held = [i for i in range(200) if not ppm.is_training(i)][:2]
    rows = [(i, "ab") for i in held]
    check(ppm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_empty_table(spark):
    assert ppm.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("texts", [["ab", "", "c"], [""], ["\0\0", "é" * 5]])
def test_grams_hold_history_and_end(texts):
    g, first = ppm.byte_grams(texts)
    assert (np.diff(first) == [len(t.encode()) + 1 for t in texts]).all()
    assert all(int(g[e - 1]) & 511 == ppm.END for e in first[1:])
