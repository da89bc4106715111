"""N-gram Jaccard join (10) against all pairs."""

import random
import re

import numpy as np
import pytest

from retailstar.llm import components, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, n=3, percent=90):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                x = len(sets[i] & sets[j])
                if 100 * x >= percent * (len(sets[i]) + len(sets[j]) - x):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted([(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=str)


def near_copies(rnd, n_families, size, length):
    rows = []
    for f in range(n_families):
        base = [f"w{rnd.randrange(2000)}" for _ in range(length + f)]
        for _ in range(size):
            t = list(base)
            for _ in range(rnd.randrange(4)):
                k = rnd.randrange(len(t))
                t[k:k + rnd.choice([0, 1])] = [f"x{rnd.randrange(10**6)}"]
            rows.append(" ".join(t))
    return rows


@pytest.mark.parametrize("hot", [4, 64])
def test_families(spark, hot):
    rnd = random.Random(hot)
    texts = near_copies(rnd, 3, 40, 60) + near_copies(rnd, 5, 4, 25) + near_copies(rnd, 2, 12, 9)
    texts += [None, "", " \n", "One", "one", "one two", "ONE two", "one two three", "é é é é", texts[0], texts[0].upper()]
    texts += [" ".join([f"w{rnd.randrange(5)}" for _ in range(rnd.randrange(30))]) for _ in range(40)]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = [(i, t) for i, t in zip(order, texts)] + [(None, texts[1]), (None, "only here of no id"), (0, "twice the id")]
    df = spark.createDataFrame([(i, t, b"x") for i, t in rows], "doc_id long, text string, name binary").repartition(4)
    assert got(ngram_join.join_documents(df, hot=hot)) == brute(rows)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(ngram_join.query(spark, sf)) == brute(rows)


def test_empty_table(spark):
    assert ngram_join.join_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_drop_near_copies_keeps_one_of_each(spark):
    rows = [(3, "a b c d"), (1, "A b c d"), (2, None), (4, ""), (None, "a b c d"), (5, "z y x"), (5, "z y x")]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n long")
    out = ngram_join.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 4, 5]


def test_prefix_bound_loses_no_link():
    """Any two sets that link share a column of both prefixes, at places the bound allows."""
    rnd = np.random.default_rng(5)
    table = rnd.integers(0, 50, ngram_join.SLOTS)
    for _ in range(400):
        n = int(rnd.integers(9, 60))
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) > 0.05], rnd.integers(0, 2**63, 1, dtype=np.uint64)]))
        x = len(np.intersect1d(a, b))
        if 100 * x >= 90 * (len(a) + len(b) - x):
            pa, pb = (ngram_join.prefix(s, table, 90).tolist() for s in (a, b))
            c = next(c for c in pa if c in pb)
            left = min(len(a) - pa.index(c), len(b) - pb.index(c))
            assert left >= ngram_join.least_overlap(np.array([len(a)]), np.array([len(b)]), 90)[0]


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (1, 0)]
    df = spark.createDataFrame(edges, "a long, b long")
    out = {r.node: r.root for r in components.components(df).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_sketches_never_differ_in_more_bits_than_members():
    rnd = np.random.default_rng(6)
    for _ in range(300):
        a = np.unique(rnd.integers(0, 2**63, int(rnd.integers(1, 900)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) > rnd.random()], rnd.integers(0, 2**63, 9, dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert ngram_join.differing(ngram_join.sketch(a), ngram_join.sketch(b)) <= apart


def test_counts_add_up_over_blocks(spark):
    """Pairs that stay: bounds on accumulated overlaps, by brute force over single columns."""
    rnd = random.Random(11)
    table = np.ones(ngram_join.SLOTS, np.int64)
    rows = {}
    for f in range(12):
        base = [rnd.randrange(1, 2**63) for _ in range(rnd.randrange(20, 60))]
        for _ in range(4):
            own = {c if rnd.random() > 0.06 else rnd.randrange(1, 2**63) for c in base}
            rows[len(rows)] = np.array(sorted(own), np.uint64)
    pre = {i: ngram_join.prefix(s, table, 90) for i, s in rows.items()}
    blocks = []
    for part in range(3):
        for i, p in pre.items():
            at = np.flatnonzero(p % np.uint64(3) == part)
            blocks.append({"part": part, "cols": p[at].tobytes(), "rids": np.full(len(at), i).tobytes(),
                           "sizes": np.full(len(at), len(rows[i]), np.uint32).tobytes(), "places": at.astype(np.uint32).tobytes()})
    df = spark.createDataFrame(blocks, "part int, cols binary, rids binary, sizes binary, places binary")
    found = df.groupBy("part").applyInPandas(ngram_join.pairs_and_hot(90, 64), ngram_join.PAIRS)
    kept = {tuple(sorted((r.a, r.b))) for r in ngram_join.accumulated(found).collect()}
    want, links = set(), set()
    for i in rows:
        for j in range(i):
            n, m = len(rows[i]), len(rows[j])
            both = [c for c in pre[i].tolist() if c in pre[j].tolist()]
            need = -(-90 * (n + m) // 190)
            if both and 100 * min(n, m) >= 90 * max(n, m):
                last = [p.tolist().index(both[-1]) for p in (pre[i], pre[j])]
                if len(both) + min(n - last[0] - 1, m - last[1] - 1) >= need:
                    want.add((j, i))
            x = len(np.intersect1d(rows[i], rows[j]))
            if 100 * x >= 90 * (n + m - x):
                links.add((j, i))
    assert links <= kept == want and links


def test_only_equal_sets_link_at_100_percent(spark):
    rows = [(1, "a b c d e"), (2, "A b c d e"), (3, "a b c d f"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_join.join_documents(df, percent=100)) == brute(rows, percent=100)


def test_common_columns_are_dealt_out_by_row(spark, monkeypatch):
    """A third of all rows share a passage: no block of columns holds them all."""
    rnd = random.Random(13)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [f"{passage} y{rnd.randrange(10**6)}" for _ in range(200)] + [
        " ".join(f"w{rnd.randrange(10**4)}" for _ in range(30)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen = []
    postings = ngram_join._postings

    def counted(*args):
        out = postings(*args)
        seen.append([r.n for r in out.groupBy("part").agg(ngram_join.F.sum(
            ngram_join.F.length("rids") / 8).alias("n")).collect()])
        return out

    monkeypatch.setattr(ngram_join, "_postings", counted)
    assert got(ngram_join.join_documents(df, hot=16)) == brute(list(enumerate(texts)))
    sizes = seen[-1]
    assert max(sizes) < 3 * sum(sizes) / len(sizes)


def test_family_without_links_sends_each_set_few_times(spark, monkeypatch, tmp_path):
    """Texts of the same phrases hang together but do not link: their sets must not go to
    every pair of blocks. Copies among them are found all the same."""
    rnd = random.Random(5)
    phrases = [[" ".join(f"s{s}p{p}w{k}" for k in range(9)) for p in range(3)] for s in range(6)]
    texts = [" ".join(rnd.choice(slot) for slot in phrases) for _ in range(240)]
    texts += [" ".join([*t.split()[:-1], f"end{k}"]) for k, t in enumerate(texts[:20])]
    texts += near_copies(rnd, 1, 60, 60)
    plain, block_links = str(tmp_path), ngram_join.block_links

    def counted(percent):
        run = block_links(percent)

        def noted(pdf):
            import uuid
            with open(f"{plain}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(pdf)))
            return run(pdf)
        return noted

    monkeypatch.setattr(ngram_join, "block_links", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 4)
    monkeypatch.setattr(ngram_join, "SKETCH_BLOCKS", 2, raising=False)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_join.join_documents(df, hot=8)) == brute(rows)
    sent = sum(int(p.read_text()) for p in tmp_path.iterdir())
    assert 0 < sent < 12 * len(rows)


@pytest.mark.parametrize("percent", [80, 90])
def test_small_blocks_meet_as_sketches(spark, monkeypatch, percent):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 2)
    monkeypatch.setattr(ngram_join, "SKETCH_BLOCKS", 2, raising=False)
    rnd = random.Random(percent)
    rows = list(enumerate(near_copies(rnd, 4, 40, 30)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_join.join_documents(df, hot=8, percent=percent)) == brute(rows, percent=percent)
