"""Hard negatives (12): against all scores, ties and odd rows; the walk's bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailstar.llm import hard_negatives as H


def brute(rows, anchor, positives=5, negatives=5, low=80, high=100):
    """rows of (id, label, vector or None)."""
    kept = [(i, lab, [int(np.floor(256 * np.float64(x))) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, (i, lab, v) in enumerate(kept):
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for n, (j, m, w) in enumerate(kept) if n != k)
        for s, j, _ in [r for r in scored if r[2] == lab][:positives]:
            fit = [r for r in scored if r[2] != lab and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(i, j, n, r[1], -s, -r[0]) for n, r in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def table(spark, rows, n=3):
    return spark.createDataFrame([(i, v, lab, 0, "x") for i, lab, v in rows],
                                 "vec_id long, embedding array<double>, label int, rank int, `a.b` string").repartition(n)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in df.collect()]
    assert got(H.query(spark, "/root/testdata/sf0.01")) == brute(rows, lambda i: i % 100 == 0)


@pytest.fixture
def small(monkeypatch):
    for name, n in (("CELL_ROWS", 4), ("BLOCK_ROWS", 16), ("BATCH_ANCHORS", 3), ("FIRST_ROWS", 20), ("SAMPLE", 150)):
        monkeypatch.setattr(H, name, n)


def clustered(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    x = centres[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, dims))
    return [(int(i), int(rng.integers(0, 3)), [round(float(c), 2) for c in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("dims,spread", [(6, 0.05), (5, 0.5)])
def test_both_walks_and_hot_cells(spark, small, dims, spread):
    rows = clustered(1, 240, dims, spread)
    rows += [(1000 + i, i % 2, rows[3][2]) for i in range(120)]      # a third of all rows: one vector
    assert got(H.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark, small):
    rows = clustered(2, 60, 4, 0.3)
    rows += [(10, 1, rows[10][2]), (10, 1, rows[10][2]), (20, 0, [5.0, 5.0, 5.0, 5.0])]    # repeated ids and rows
    rows += [(None, 1, [1.0] * 4), (70, None, [1.0] * 4), (80, 1, None), (90, 1, [1.0, None, 0.0, 0.0]),
             (100, 1, [float("nan")] * 4), (110, 1, [float("-inf")] * 4), (120, 2, []), (130, 2, [1.0]), (140, 2, [1.0] * 6)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert got(H.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0)) == want
    assert got(H.hard_negatives(table(spark, rows, 1), F.col("vec_id") % 10 == 0)) == want


def test_without_anchors_or_rows(spark):
    rows = clustered(3, 12, 4, 0.3)
    assert H.hard_negatives(table(spark, rows), F.lit(False)).count() == 0
    assert H.hard_negatives(table(spark, rows).where("false"), F.lit(True)).count() == 0
    # one label only: no negatives; negative scores only: no window
    assert H.hard_negatives(table(spark, [(i, 1, v) for i, _, v in rows]), F.lit(True)).count() == 0


def test_walk_is_in_order_and_bounds_hold():
    rng = np.random.default_rng(6)
    x = rng.integers(-256, 257, (300, 7))
    first, second = H.codebook(x[:, :4], 6), H.codebook(x[:, 4:], 6)
    a, b = H.nearest(x[:, :4], first), H.nearest(x[:, 4:], second)
    far = [np.array([max([((p - w) ** 2).sum() for p in part[own == k]], default=0) for k, w in enumerate(words)])
           for part, words, own in ((x[:, :4], first, a), (x[:, 4:], second, b))]
    cells = {}
    for i, c in enumerate(zip(a.tolist(), b.tolist())):
        cells.setdefault(c, []).append(i)
    own = {c: (len(v), *[int(H.V.up_root(max(((x[i, cut] - w) ** 2).sum() for i in v)))
                         for cut, w in ((slice(0, 4), first[c[0]]), (slice(4, 7), second[c[1]]))])
           for c, v in cells.items()}
    index = H.Index(first, second, (H.V.up_root(far[0]), H.V.up_root(far[1])), own, 7)
    for q in x[:20]:
        walk = list(index.walk(q))
        assert [w[0] for w in walk] == sorted((w[0] for w in walk), reverse=True)
        assert sorted(w[1:] for w in walk) == sorted(cells)
        for bound, c1, c2 in walk:
            tight = index.cell_bound(q)(c1, c2)
            assert tight <= bound and all(q @ x[i] <= tight for i in cells[c1, c2])


def test_walk_leaves_cells_out(spark):
    """Tight clusters: most cells are under the bound of what is needed."""
    rows = clustered(8, 400, 6, 0.01)
    x = np.floor(256 * np.array([v for _, _, v in rows])).astype(np.int64)
    first, second = H.codebook(x[:, :3], 8), H.codebook(x[:, 3:], 8)
    a, b = H.nearest(x[:, :3], first), H.nearest(x[:, 3:], second)
    far = [np.array([max([((p - w) ** 2).sum() for p in part[own == k]], default=0) for k, w in enumerate(words)])
           for part, words, own in ((x[:, :3], first, a), (x[:, 3:], second, b))]
    cells = {c: (1, 0, 0) for c in zip(a.tolist(), b.tolist())}
    index = H.Index(first, second, (H.V.up_root(far[0]), H.V.up_root(far[1])), cells, 6)
    q = x[0]
    need = np.sort(x @ q)[-5]
    assert sum(bound >= need for bound, _, _ in index.walk(q)) < len(cells) / 2
