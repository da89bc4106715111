"""Centroid clustering (13): against plain distances, ties and odd vectors."""

import hashlib

import numpy as np

from retailstar.llm import centroid_clustering as C


def brute(rows, dims, k, rounds, scale=256, seed=2):
    """rows of (id, vector): the same clustering with every distance computed."""
    kept = [(i, [int(np.floor(scale * np.float64(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, *nearest(v)) for i, v in kept]
    per = {j: sum(d for _, d, c in out if c == j) for j in range(len(cents))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, per[c], sum(per.values()), digest[c]) for i, d, c in out), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(C.cluster_vectors(df)) == brute(rows, 64, 40, 5)


def test_sign_tests_find_the_nearest():
    rng = np.random.default_rng(3)
    # few values: many centroids at equal distance, and equal centroids
    for _ in range(30):
        x, c = rng.integers(-3, 4, (200, 4)), rng.integers(-3, 4, (9, 4))
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (C.Tournament(c).winners(x) == d.argmin(axis=1)).all()


def test_large_components_are_exact():
    rng = np.random.default_rng(4)
    c = rng.integers(-2 ** 26 + 1, 2 ** 26, (12, 64))
    x = np.concatenate([c + rng.integers(-1, 2, c.shape), (c[:-1] + c[1:]) // 2])
    d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
    assert C.Tournament(c).winners(x).tolist() == [min(range(12), key=lambda j: (r[j], j)) for r in d]


def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 3) / 256]) for i in range(60)]
    rows += [(100 + i, [0.01, 0.02, -0.03]) for i in range(40)]                        # copies
    rows += [(7, rows[7][1]), (7, [0.5, 0.5, 0.5]), (None, [0.0, 0.0, 0.1])]           # repeated and null ids
    rows += [(200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, 2.0, None]), (204, [float("nan"), 0.0, 0.0]),
             (205, [float("inf"), 0.0, 0.0]), (206, [0.0, 0.0, 0.0, 0.0])]
    return rows


def test_odd_vectors_ties_and_clashing_columns(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, cluster int, `a.b` string").repartition(4)
    kw = dict(dims=3, k=9, rounds=4)
    assert got(C.cluster_vectors(df, **kw)) == brute(rows, 3, 9, 4)
    # another layout, the same result; more clusters than vectors
    assert got(C.cluster_vectors(df.repartition(1), **kw)) == brute(rows, 3, 9, 4)
    few = df.where("vec_id < 5")
    assert got(C.cluster_vectors(few, **kw)) == brute([r for r in rows if r[0] is not None and r[0] < 5], 3, 9, 4)


def test_empty_table(spark):
    out = C.cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
