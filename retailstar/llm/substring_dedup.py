r"""Substring dedup (3): recompression.

Words are named by hash; rounds of recompression then rename runs of one symbol
(a, k) and pairs (a, b) of a left and a right symbol, sides drawn from the
symbol itself. What a symbol becomes depends on itself, its neighbours and, where
a partner may be in a run, the partner's other neighbour, so equal substrings get equal interior symbols wherever they stand, and names
made by hashing are the same in every task: no dictionary has to be shuffled.
Each symbol carries the range of words that decided it. If a window of ``n``
words occurs twice, every symbol decided inside it occurs twice. So a symbol
found once in the whole corpus rules out all windows around it; the windows that
are left (near copies and shared passages, hardly any others) are verified:
their 128-bit word hashes are counted over the corpus.

Texts are written once as packs, bucketed by pack. Packs ask with the distinct
names they hold, dealt out by name; each bucket answers with one bit per name,
which returns to the pack without moving a text again. A name comes at most once
per pack, so a passage that a third of the documents share is no hot key.

Words are `[^\x20\x09-\x0D]+`. Defined results: a null text has no words (digest
of the empty string); texts under ``n`` words stay whole; repeated rows repeat
each other's windows, so both lose them; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packs as P
from . import words as W
from .common import read_documents, sha256, stored

WINDOW = 35
ROUNDS = 4
_U = np.uint64


def recompress(h: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, lo, hi) after the rounds: words lo <= i < hi decided the symbol.

    ``first``: offsets of the texts; -1 / beyond stand for a text's border.
    """
    n = len(h)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    sym, lo, hi = h, np.arange(n), np.arange(1, n + 1)
    for r in range(rounds):
        if not len(sym):
            break
        next_same_doc = np.zeros(len(sym), bool)
        next_same_doc[:-1] = doc[1:] == doc[:-1]
        equal = np.zeros(len(sym), bool)
        equal[:-1] = next_same_doc[:-1] & (sym[1:] == sym[:-1])
        side = (W.mix(sym + _U((r + 1) * 0xD1B54A32D192ED03 % 2**64)) >> _U(63)).astype(bool)
        pair = np.zeros(len(sym), bool)
        pair[:-1] = next_same_doc[:-1] & ~side[:-1] & side[1:] & ~equal[:-1]
        # a symbol of a run joins its run, not a pair
        in_run = equal.copy()
        in_run[1:] |= equal[:-1]
        # what was looked at: the neighbour on each side; where a pair is in question also the
        # partner's other neighbour, which may hold the partner in a run
        lo, hi = _looked_at(lo, hi, doc, pair & ~in_run, np.append(False, pair[:-1]) & ~in_run)
        pair[:-1] &= ~in_run[:-1] & ~in_run[1:]
        joined = np.zeros(len(sym), bool)  # joined to the one before
        joined[1:] = equal[:-1] | pair[:-1]
        head = np.flatnonzero(~joined)
        size = np.diff(np.append(head, len(sym)))
        a = sym[head]
        b = sym[np.minimum(head + 1, len(sym) - 1)]
        two, run = (size > 1) & ~equal[head], (size > 1) & equal[head]
        new = np.where(two, W.mix(W.mix(a + _U(0x9E3779B97F4A7C15)) ^ b), a)
        new = np.where(run, W.mix(a ^ W.mix(size.astype(np.uint64) + _U(0x632BE59BD9B4E019))), new)
        sym, lo, hi, doc = new, np.minimum.reduceat(lo, head), np.maximum.reduceat(hi, head), doc[head]
    return sym, lo, hi


def _looked_at(lo: np.ndarray, hi: np.ndarray, doc: np.ndarray, after: np.ndarray,
               before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of all symbols with their neighbours', and with the second one's to the
    right (``after``) or left (``before``). A border counts as outside any window."""
    out_lo, out_hi = lo.copy(), hi.copy()
    for step, where in ((1, None), (2, after), (-1, None), (-2, before)):
        k = abs(step)
        here, there = (slice(None, -k), slice(k, None)) if step > 0 else (slice(k, None), slice(None, -k))
        same = np.zeros(len(lo), bool)
        same[here] = doc[here] == doc[there]
        far_lo, far_hi = np.full(len(lo), -(1 << 40)), np.full(len(lo), 1 << 40)
        far_lo[here], far_hi[here] = lo[there], hi[there]
        far_lo[~same], far_hi[~same] = -(1 << 40), 1 << 40
        if where is not None:
            far_lo, far_hi = np.where(where, far_lo, lo), np.where(where, far_hi, hi)
        out_lo, out_hi = np.minimum(out_lo, far_lo), np.maximum(out_hi, far_hi)
    return out_lo, out_hi


class Parsed:
    """Words and symbols of one pack."""

    def __init__(self, texts: list, window: int, rounds: int, second: bool = False):
        self.w = W.split(W.utf8(texts))
        self.n = window
        self.h = self.w.hashes(0)
        sym, lo, hi = recompress(self.h, self.w.first, rounds)
        inner = (hi - lo <= window) & (lo >= 0)
        self.sym, self.lo, self.hi = sym[inner], lo[inner], hi[inner]
        self.second = self.w.hashes(1) if second else None

    def names(self) -> np.ndarray:
        return self.sym

    def candidates(self, twice: np.ndarray) -> np.ndarray:
        """Window starts that no symbol rules out; ``twice`` is per symbol."""
        n, k = len(self.h), self.n
        starts = np.zeros(n + 1, np.int64)
        lone = ~twice
        # the windows that hold [lo, hi): starts hi - k .. lo
        np.add.at(starts, np.maximum(self.hi[lone] - k, 0), 1)
        np.add.at(starts, self.lo[lone] + 1, -1)
        free = np.cumsum(starts[:n]) == 0
        doc = self.w.doc()
        fits = np.zeros(n, bool)
        if n >= k:
            fits[:n - k + 1] = doc[:n - k + 1] == doc[k - 1:]
        return np.flatnonzero(free & fits)

    def window_names(self, at: np.ndarray) -> np.ndarray:
        """Two 64-bit lanes per window, as an (m, 2) array."""
        return np.column_stack([W.grams(self.h, self.n)[at], W.grams(self.second, self.n)[at]])

    def covered(self, at: np.ndarray) -> np.ndarray:
        step = np.zeros(len(self.h) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + self.n, -1)
        return np.cumsum(step[:-1]) > 0


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names, whether each is there twice, and the place of every name in them."""
    u, inv, n = np.unique(names, return_inverse=True, return_counts=True)
    return u, (n > 1).astype(np.uint8), inv.ravel()


def _distinct_windows(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((lanes[:, 1], lanes[:, 0]))
    s = lanes[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1)
    group = np.cumsum(new) - 1
    inv = np.empty(len(s), np.int64)
    inv[order] = group
    return s[new], (np.bincount(group, minlength=int(new.sum())) > 1).astype(np.uint8), inv


def dedup_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    rounds: int = ROUNDS, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept words as ``kept_text``) of every row."""
    spark, written = docs.sparkSession, P.new_table()
    packs, parts = P.packed(docs, id_col, text_col, table=written)

    def ask_symbols(ids, texts):
        u, many, _ = _distinct(Parsed(texts, window, rounds).names())
        return u, {"names": u, "many": many}

    shared = stored(P.answer(P.ask(packs, ["names", "many"], parts, ask_symbols), parts, P.seen_twice), "dedup-symbols")
    known = P.with_answers(packs, shared, parts, "shared")

    def windows(texts, rows):
        p = Parsed(texts, window, rounds, second=True)
        u, _, inv = _distinct(p.names())
        at = p.candidates(P.told(rows, u, parts, np.uint8)[inv].astype(bool))
        lanes, many, place = _distinct_windows(p.window_names(at))
        return p, at, lanes, many, place

    def ask_windows(ids, texts, rows):
        _, _, lanes, many, _ = windows(texts, rows)
        return lanes[:, 0], {"names": lanes, "many": many}

    repeated = P.answer(P.ask(known, ["names", "many"], parts, ask_windows, ["shared"]), parts,
                        lambda pdf: P.seen_twice(pdf, 2))
    fields = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def apply(batches):
        import pyarrow as pa
        for batch in batches:
            cols = [batch.column(c) for c in ("ids", "texts", "shared", "again")]
            for i in range(batch.num_rows):
                ids, texts, rows, again = [c[i].as_py() for c in cols]
                p, at, lanes, _, place = windows(texts, rows)
                twice = P.told(again, lanes[:, 0], parts, np.uint8)[place].astype(bool)
                gone = p.covered(at[twice])
                out = _kept(p.w, gone)
                arrays = [pa.array(ids, pa.int64()), pa.array(p.w.counts, pa.int64()),
                          pa.array([x[0] for x in out], pa.int64()), pa.array([sha256(x[1]) for x in out])]
                if with_text:
                    arrays.append(pa.array([x[1].decode("utf-8", "replace") for x in out], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in fields.split(", ")])

    both = P.with_answers(known, repeated, parts, "again")
    out = stored(both.select("ids", "texts", "shared", "again").mapInArrow(apply, fields), "dedup-documents")
    P.drop(spark, written)
    return out


def _kept(w: W.Words, gone: np.ndarray) -> list[tuple[int, bytes]]:
    """(removed words, kept words joined by one space) of every text."""
    # bytes of kept words, and one space before each but a text's first
    keep = ~gone
    step = np.zeros(len(w.buf) + 1, np.int8)
    step[w.start[keep]] += 1
    step[w.end[keep]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    # the byte after a kept word is a separator: it becomes the space
    sep = w.end[keep]
    buf = w.buf.copy()
    buf[sep] = 0x20
    inside[sep] = True
    at = np.concatenate([[0], np.cumsum(inside)])
    out_bytes = buf[inside].tobytes()
    bounds = at[w.at]
    removed = np.concatenate([[0], np.cumsum(gone)])
    return [(int(removed[w.first[i + 1]] - removed[w.first[i]]),
             out_bytes[bounds[i]:max(bounds[i], bounds[i + 1] - 1)] if bounds[i + 1] > bounds[i] else b"")
            for i in range(len(w.first) - 1)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_documents(read_documents(spark, sf_dir))
