"""Document fingerprints (7): improbable-feature digests.

A feature is a window of 64 bytes, from any byte on. A window's rank is how rare
its entropy is among all windows of the corpus: a Spark aggregate counts entropy
levels over every window of every document (a table of at most LEVELS rows). Every
64 windows that follow one another in a text (fewer at its ends) vote for the
rarest, leftmost first; windows with 16 votes are features. Texts under SHORT
bytes have windows of eight bytes besides, ranked and elected likewise by four,
since an edit leaves few of their long windows as they were. Features go into
Bloom filters of 2048 bits, five bits each, a new filter after 160 features. Two
chains compare by the bits that their filters share beyond chance, relative to the
most they could share.

The entropy of all windows comes from one running sum: a step adds a byte and
drops another, by how often each stands among its 63 neighbours.

The next document of each is found by ranges of doc_id: each range is one sorted
run of a task, and the first document of the following range comes along.

Defined results: a null or empty text has the empty fingerprint (likeness 1 to
another empty one, 0 to any other); a text under eight bytes is one feature; a very
long text is digested whole; equal ids are ordered by text, a null id comes first;
repeated rows each get their row; the only document of a table is its own next; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import annotate, read_documents, sha256, shuffle_partitions

@dataclass(frozen=True)
class Kind:
    """Windows of ``width`` bytes; ``voters`` that follow one another elect, a feature has ``votes``."""

    width: int
    voters: int
    votes: int
    #: place of its entropy levels in the common table
    first: int

    @property
    def top(self) -> int:
        """The highest entropy, in hundredths of a bit."""
        return round(100 * np.log2(self.width))


LONG_WINDOWS = Kind(64, 64, 16, 0)
SHORT_WINDOWS = Kind(8, 4, 2, LONG_WINDOWS.top + 1)
#: texts under so many bytes have windows of both kinds
SHORT = 512
LEVELS = SHORT_WINDOWS.first + SHORT_WINDOWS.top + 1
FILTER_BITS = 2048
FILTER_FEATURES = 160
_U = np.uint64
#: c log2 c in whole numbers, so that running sums are exact
_SCALE = 1 << 20
_C_LOG_C = np.rint(_SCALE * np.array([0.0] + [c * np.log2(c) for c in range(1, 65)])).astype(np.int64)
_STEP = np.diff(_C_LOG_C)
_NONE = np.iinfo(np.int32).max


def _joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins."""
    at = np.zeros(len(raws) + 1, np.int64)
    np.cumsum([len(r) for r in raws], out=at[1:])
    return np.frombuffer(b"".join(raws), np.uint8), at


def entropy_levels(buf: np.ndarray, kind: Kind, block: int = 1 << 16) -> np.ndarray:
    """Entropy of the window from every byte on, in hundredths of a bit."""
    w = kind.width
    out = np.empty(max(0, len(buf) - w + 1), np.int16)
    for i in range(0, len(out), block):
        x = buf[i:i + block + w - 1]
        n = len(x) - w + 1
        before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
        for k in range(1, w):
            same = (x[k:] == x[:-k]).view(np.uint8)
            before[k:] += same
            after[:-k] += same
        total = np.empty(n, np.int64)
        total[0] = _C_LOG_C[np.bincount(x[:w], minlength=256)].sum()
        # the byte before goes, the last one comes
        np.subtract(_STEP[before[w:]], _STEP[after[:n - 1]], out=total[1:])
        np.cumsum(total, out=total)
        out[i:i + n] = np.rint(kind.top - total * (100 / (w * _SCALE)))
    return out


def _inside(at: np.ndarray, kind: Kind) -> np.ndarray:
    """Marks windows that end in the text in which they begin."""
    ok = np.ones(max(0, int(at[-1]) - kind.width + 1), bool)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        ok[max(lo, hi - kind.width + 1):hi] = False
    return ok


def level_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Windows per entropy level over all documents (at most LEVELS rows arrive here)."""
    def count(texts: list) -> dict:
        buf, at = _joined(W.utf8(texts))
        n = np.zeros(LEVELS, np.int64)
        for kind in (LONG_WINDOWS, SHORT_WINDOWS):
            got = np.bincount(entropy_levels(buf, kind)[_inside(at, kind)], minlength=kind.top + 1)
            n[kind.first:kind.first + kind.top + 1] = got
        # one row per slice holds the counts, the others are null
        return {"counts": [n.tolist(), *[None] * (len(texts) - 1)]}
    rows = annotate(docs, text_col, {"counts": "array<long>"}, count, []).where("counts IS NOT NULL")
    each = rows.select(F.posexplode("counts").alias("level", "n")).where("n > 0")
    out = np.zeros(LEVELS, np.int64)
    for r in each.groupBy("level").agg(F.sum("n").alias("n")).collect():
        out[r["level"]] = r["n"]
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank per level of each kind, the rarest 0; under one bit of entropy (long runs) comes last."""
    rank = np.empty(LEVELS, np.int32)
    for kind in (LONG_WINDOWS, SHORT_WINDOWS):
        level = np.arange(kind.top + 1)
        order = np.lexsort((level, counts[kind.first + level], level < 100))
        rank[kind.first + order] = level
    return rank


def elected(raws: list[bytes], kind: Kind, rank: np.ndarray, block: int = 1 << 18) -> tuple[np.ndarray, ...]:
    """(text, place in the text, 64-bit hash) of the windows that enough voters prefer."""
    buf, at = _joined(raws)
    ok = _inside(at, kind)
    key = np.where(ok, rank[kind.first:][entropy_levels(buf, kind)], -1)
    v, picks = kind.voters, []
    for i in range(0, len(key), block):
        # voters reach so far to both sides; beyond the texts there is nothing to elect
        lo, hi = i - v + 1, min(i + block, len(key)) + v - 1
        mine = np.full(hi - lo, -1, np.int32)
        mine[max(0, -lo):min(hi, len(key)) - lo] = key[max(0, lo):hi]
        low = np.where(mine < 0, _NONE, (mine << 19) + np.arange(len(mine), dtype=np.int32))
        size = 1
        while size < v:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        votes = np.bincount(low[low != _NONE] & ((1 << 19) - 1), minlength=len(mine))
        picks.append(i + np.flatnonzero(votes[v - 1:len(mine) - v + 1] >= kind.votes))
    pick = np.concatenate(picks) if picks else np.zeros(0, np.int64)
    text = np.searchsorted(at, pick, "right") - 1
    return text, pick - at[text], _window_hashes(buf, pick, kind.width)


def features(raws: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, 64-bit feature) of every elected window, in text order."""
    parts = [elected(raws, LONG_WINDOWS, rank)]
    short = np.array([i for i, r in enumerate(raws) if SHORT_WINDOWS.width <= len(r) < SHORT], np.int64)
    text, place, h = elected([raws[i] for i in short], SHORT_WINDOWS, rank)
    parts.append((short[text], place, h))
    tiny = [i for i, r in enumerate(raws) if 0 < len(r) < SHORT_WINDOWS.width]
    # the length stands in the last byte
    whole = np.array([int.from_bytes(raws[i].ljust(7, b"\0") + bytes([len(raws[i])]), "little") for i in tiny], np.uint64)
    parts.append((np.array(tiny, np.int64), np.zeros(len(tiny), np.int64), W.mix(whole)))
    text, place, h = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((place, text))
    return text[order], h[order]


def _window_hashes(buf: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    lanes = np.lib.stride_tricks.sliding_window_view(buf, width)[start].copy().view(np.uint64)
    h = np.full(len(start), width, np.uint64)
    for k in range(width // 8):
        h = W.mix(h * _U(0x9E3779B97F4A7C15) + lanes[:, k])
    return h


def chains(raws: list[bytes], rank: np.ndarray) -> list[bytes]:
    """The chained filters of every text, one after another."""
    got, h = features(raws, rank)
    n = len(raws)
    # a feature counts once per text, at its first place
    _, first = np.unique(W.mix(h ^ W.mix(got.astype(np.uint64) + _U(1))), return_index=True)
    first.sort()
    got, h = got[first], h[first]
    count = np.bincount(got, minlength=n)
    begin = np.cumsum(count) - count
    filters = -(-count // FILTER_FEATURES)
    base = np.cumsum(filters) - filters
    which = base[got] + (np.arange(len(got)) - begin[got]) // FILTER_FEATURES
    bits = np.zeros(int(filters.sum()) * FILTER_BITS, bool)
    for k in range(5):
        bits[which * FILTER_BITS + ((h >> _U(11 * k)) & _U(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits).tobytes()
    size = FILTER_BITS // 8
    return [packed[base[i] * size:(base[i] + filters[i]) * size] for i in range(n)]


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: each filter of the shorter chain against its best match, by bits set."""
    if a == b:
        return 1.0
    size = FILTER_BITS // 8
    x, y = sorted(([int.from_bytes(c[i:i + size], "big") for i in range(0, len(c), size)] for c in (a, b)), key=len)
    if not x:
        return 0.0
    ny = [f.bit_count() for f in y]
    total = weight = 0.0
    for f in x:
        nf = f.bit_count()
        best = 0.0
        for g, ng in zip(y, ny):
            chance = nf * ng / FILTER_BITS
            best = max(best, ((f & g).bit_count() - chance) / max(min(nf, ng) - chance, 1e-9))
        total += nf * best
        weight += nf
    return min(1.0, total / weight)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _digest_rows(ids: list, texts: list[str], rank: np.ndarray) -> dict:
    """Rows for all texts but the last, which is only the next one."""
    n = len(ids) - 1
    edited = []
    for i in range(n):
        t, k = texts[i], len(texts[i]) // 4
        edited.append(t[:len(t) - k] + texts[i + 1][:k])
    raws, more = W.utf8(texts), W.utf8(edited)
    own, changed = chains(raws, rank), chains(more, rank)
    return {"doc_id": ids[:n], "n_chars": [len(t) for t in texts[:n]], "edited_sha256": [sha256(m) for m in more],
            "fingerprint": [base64.b64encode(c).decode() for c in own[:n]],
            "edited_fingerprint": [base64.b64encode(c).decode() for c in changed],
            "near_edited": [likeness(own[i], changed[i]) for i in range(n)],
            "near_next": [likeness(own[i], own[i + 1]) for i in range(n)]}


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                          limit: int = 2 << 20) -> DataFrame:
    """One row per document, see SCHEMA."""
    spark = docs.sparkSession
    rank = rarity(level_counts(docs, text_col))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(id_col).cast("long"), F.lit(-2**63)).alias("id"), F.col(text_col).alias("text"))
    n = 4 * shuffle_partitions(spark)
    bounds = sorted(set(d.approxQuantile("id", [i / n for i in range(1, n)], 1e-3)))
    place = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]).cast("array<long>"), lambda b: b < F.col("id")))
    d = d.withColumn("place", place)
    # one row per range: its smallest id; the row goes to the range before, too
    least = sorted((r["place"], r["m"]) for r in d.groupBy("place").agg(F.min("id").alias("m")).collect())
    before = {p: least[i - 1][0] for i, (p, _) in enumerate(least)}
    small, to = [None] * (len(bounds) + 1), [None] * (len(bounds) + 1)
    for p, m in least:
        small[p], to[p] = m, before[p]
    at = F.col("place") + 1
    here = F.struct(F.col("place").alias("run"), F.lit(0).alias("extra"))
    there = F.struct(F.element_at(F.array(*map(F.lit, to)).cast("array<int>"), at).alias("run"), F.lit(1).alias("extra"))
    first = F.col("id") == F.element_at(F.array(*map(F.lit, small)).cast("array<long>"), at)
    d = d.select("doc_id", "id", "text", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))).alias("x"))
    d = d.select("doc_id", "id", "text", "x.run", "x.extra")
    d = d.repartition(shuffle_partitions(spark), "run").sortWithinPartitions("run", "extra", "id", "text")
    d = d.select("doc_id", "text", "extra")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        extra: list[int] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            got = _digest_rows(ids, texts, rank)
            keep = [i for i in range(len(ids) - 1) if not extra[i]]
            if keep:
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array([v[i] for i in keep], type=t) for (k, v), t in zip(got.items(), types)})

        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            cols = batch.to_pydict()
            for i, t, x in zip(cols["doc_id"], cols["text"], cols["extra"]):
                ids.append(i)
                texts.append(t or "")
                extra.append(x)
                size += len(t or "")
                if size > limit and len(ids) > 1:
                    yield from flush()
                    ids, texts, extra = ids[-1:], texts[-1:], extra[-1:]
                    size = len(texts[0])
        if len(ids) > 1:
            yield from flush()

    return d.mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read_documents(spark, sf_dir))
