"""Fingerprints (7): the edited text by brute force, likeness of equal, edited and other texts."""

import hashlib
from collections import Counter

import numpy as np

from retailstar.llm import fingerprints as P


def want(rows):
    """(n_chars, edited digest) per row in order of id, then text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[:len(t) - q] + nxt[:q]).encode()).hexdigest()))
    return sorted(out, key=str)


def check(df, rows):
    out = df.collect()
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in out], key=str) == want(rows)
    assert all(0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0 for r in out)
    return out


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = check(P.query(spark, sf), rows)
    text = dict(rows)
    prints = {}
    for r in out:
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in out if r.n_chars >= 400]
    assert np.median([r.near_edited for r in long]) > 0.6 and np.mean([r.near_edited > 0.4 for r in long]) > 0.95
    other = [r.near_next for r, n in zip(sorted(long, key=lambda r: r.doc_id), long[1:])]
    assert np.median(other) < 0.1


def test_edges(spark):
    rows = [(5, None), (1, ""), (2, "short"), (9, "ab" * 40), (3, "a" * 5000), (4, "é日本😀" * 200), (2, "short"), (None, "no id at all"),
            (7, "x" * 63), (8, "x" * 64), (-3, "negative")]
    df = spark.createDataFrame([(i, t, "f") for i, t in rows], "doc_id long, text string, fingerprint string").repartition(4)
    out = check(P.fingerprint_documents(df, limit=100), rows)
    by = {r.doc_id: r for r in out}
    assert by[1].fingerprint == by[5].fingerprint == ""
    assert by[2].fingerprint and by[9].fingerprint and by[3].fingerprint


def test_one_row_and_empty_table(spark):
    one = [(1, "only one document here " * 10)]
    df = spark.createDataFrame(one, "doc_id long, text string")
    assert check(P.fingerprint_documents(df), one)[0].near_next == 1.0
    assert P.fingerprint_documents(df.limit(0)).count() == 0


def levels(raw, kind):
    """Entropy of every window, by its byte counts."""
    out = []
    for i in range(len(raw) - kind.width + 1):
        n = np.array(list(Counter(raw[i:i + kind.width]).values()))
        out.append(100 * (np.log2(kind.width) - (n * np.log2(n)).sum() / kind.width))
    return out


def brute_features(raw, rank):
    """Windows elected one by one: (place, bytes)."""
    out = []
    for kind in (P.LONG_WINDOWS, P.SHORT_WINDOWS):
        if kind is P.SHORT_WINDOWS and len(raw) >= P.SHORT:
            continue
        r = [rank[kind.first + round(float(x))] for x in levels(raw, kind)]
        votes = Counter()
        for s in range(1 - kind.voters, len(r)) if r else ():
            seen = [(r[i], i) for i in range(max(0, s), min(len(r), s + kind.voters))]
            votes[min(seen)[1]] += 1
        out += [(i, raw[i:i + kind.width]) for i, n in votes.items() if n >= kind.votes]
    return sorted(out, key=lambda x: x[0])


def some_texts(rng):
    words = [bytes(rng.integers(97, 123, rng.integers(2, 10), dtype=np.uint8)) for _ in range(300)]
    sizes = [0, 3, 7, 8, 9, 63, 64, 65, 100, 127, 128, 200, 511, 512, 700, 1500]
    return [b" ".join(words[i] for i in rng.integers(0, 300, n))[:n] for n in sizes] + [b"a" * 300, b"ab" * 400, b"\0" * 80]


def test_features_by_brute_force():
    rng = np.random.default_rng(5)
    raws = some_texts(rng)
    rank = P.rarity(rng.integers(0, 50, P.LEVELS))
    got = [[] for _ in raws]
    for t, h in zip(*P.features(raws, rank)):
        got[t].append(int(h))
    hashed = {}
    for i, raw in enumerate(raws):
        if len(raw) < 8:
            assert len(got[i]) == (len(raw) > 0)
            continue
        want = [x for _, x in brute_features(raw, rank)]
        assert len(got[i]) == len(want), len(raw)
        # a hash stands for one window
        assert all(hashed.setdefault(h, x) == x for h, x in zip(got[i], want))
    assert len(set(hashed.values())) == len(hashed) > 200


def test_blocks_and_slices_change_nothing():
    rng = np.random.default_rng(6)
    raws = some_texts(rng)
    buf, _ = P._joined(raws)
    rank = P.rarity(rng.integers(0, 50, P.LEVELS))
    for kind in (P.LONG_WINDOWS, P.SHORT_WINDOWS):
        assert (P.entropy_levels(buf, kind) == P.entropy_levels(buf, kind, block=97)).all()
        one = P.elected(raws, kind, rank)
        assert all((a == b).all() for a, b in zip(one, P.elected(raws, kind, rank, block=70)))
    assert P.chains(raws, rank) == [c for r in raws for c in P.chains([r], rank)]


def test_long_text():
    rng = np.random.default_rng(8)
    raw = bytes(rng.integers(32, 127, 5_000_000, dtype=np.uint8))
    rank = P.rarity(np.bincount(P.entropy_levels(np.frombuffer(raw, np.uint8), P.LONG_WINDOWS), minlength=P.LEVELS))
    a, b = P.chains([raw[:400_000], raw[:300_000] + raw[-100_000:]], rank)
    assert 0.6 < P.likeness(a, b) < 0.9
    assert len(P.chains([raw], rank)[0]) > 100_000


def brute_likeness(a, b):
    """Bit by bit."""
    def filters(c):
        bits = [(byte >> (7 - k)) & 1 for byte in c for k in range(8)]
        return [bits[i:i + P.FILTER_BITS] for i in range(0, len(bits), P.FILTER_BITS)]
    x, y = sorted((filters(a), filters(b)), key=len)
    total = weight = 0
    for f in x:
        best = 0.0
        for g in y:
            chance = sum(f) * sum(g) / P.FILTER_BITS
            both = sum(i and j for i, j in zip(f, g))
            best = max(best, (both - chance) / (min(sum(f), sum(g)) - chance))
        total, weight = total + sum(f) * best, weight + sum(f)
    return min(1.0, total / weight)


def test_likeness_by_brute_force():
    rng = np.random.default_rng(7)
    raws = [r for r in some_texts(rng) if len(r) >= 100]
    rank = P.rarity(rng.integers(0, 50, P.LEVELS))
    prints = P.chains(raws + [r[:len(r) * 3 // 4] + raws[0] for r in raws], rank)
    for a in prints[::3]:
        for b in prints[::2]:
            if a != b:
                assert abs(P.likeness(a, b) - brute_likeness(a, b)) < 1e-9


def test_short_edited_texts(spark):
    """Three quarters of a text of 64 characters or more are enough to know it again."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    for low, high in ((64, 99), (100, 139), (140, 199), (200, 259), (260, 500), (500, 600), (600, 1000)):
        cut = [(i, r.text[:low + i % (high - low)]) for i, r in enumerate(rows) if len(r.text or "") >= high]
        out = P.fingerprint_documents(spark.createDataFrame(cut, "doc_id long, text string")).collect()
        near = np.array([r.near_edited for r in out])
        assert np.mean(near > 0.3) >= 0.95, (low, np.mean(near > 0.3), np.quantile(near, [0.01, 0.05, 0.5]))


def test_entropy_and_likeness():
    buf = np.frombuffer(b"a" * 64 + bytes(range(64)), np.uint8)
    got = P.entropy_levels(buf, P.LONG_WINDOWS)
    assert (got[0], got[64]) == (0, 600)
    rank = P.rarity(np.ones(P.LEVELS, np.int64))
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 40_000, dtype=np.uint8))
    a, b, c = P.chains([text, text[:30_000] + text[:10_000][::-1], text[::-1]], rank)
    assert P.likeness(a, a) == 1.0 and P.likeness(a, b) > 0.6 > 0.1 > P.likeness(a, c)
    assert P.likeness(b"", b"") == 1.0 and P.likeness(b"", a) == 0.0


def test_inserted_text_shifts_features_only():
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 123, 5000, dtype=np.uint8))
    rank = P.rarity(rng.integers(0, 50, P.LEVELS))
    one, other = P.features([text], rank)[1], P.features([b"xyz" + text], rank)[1]
    assert len(set(one) - set(other)) <= 2
