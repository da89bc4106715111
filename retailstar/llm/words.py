"""Vectorised word kernels: whole texts in, numpy arrays of word spans and
hashes out.

All functions run inside tasks on one slice of texts. Words are maximal runs
of bytes outside a separator set; every separator is ASCII, so byte positions
in UTF-8 split exactly where code points do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: bytes of a word `[^\x20\x09-\x0D]+`
WORD_BYTES = ~_SPACE
#: bytes of a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, a-z, all above ASCII
ALNUM_BYTES = np.zeros(256, bool)
ALNUM_BYTES[0x30:0x3A] = ALNUM_BYTES[0x61:0x7B] = ALNUM_BYTES[0x80:] = True
#: maps A-Z to a-z and keeps every other byte
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)
_TABLE = [np.random.default_rng(20240 + k).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
          for k in (0, 1)]
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def mix(z: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, elementwise."""
    z = z ^ (z >> _U(30))
    z = z * _U(0xBF58476D1CE4E5B9)
    z ^= z >> _U(27)
    z *= _U(0x94D049BB133111EB)
    z ^= z >> _U(31)
    return z


def _powers(lane: int, n: int, inverse: bool = False) -> np.ndarray:
    """``base**i`` (or its inverse) modulo 2**64 for i < n, kept between calls."""
    have = _POWERS.get((lane, inverse))
    if have is None or len(have) < n:
        base = pow(_BASE[lane], -1, 2**64) if inverse else _BASE[lane]
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 1 << 23:
            _POWERS[lane, inverse] = have
    return have[:n]


@dataclass
class Words:
    """Words of a slice of texts: byte spans in ``buf``; text i has the words
    ``first[i]:first[i + 1]``."""

    buf: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lane: int = 0, block: int = 1 << 20) -> np.ndarray:
        """A 64-bit hash of every word's bytes. ``block`` bounds the bytes
        hashed at once, so a very long text needs no more memory."""
        out = np.empty(len(self), np.uint64)
        i = 0
        while i < len(self):
            lo = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, lo + block, "right")))
            part = self.buf[lo:self.end[j - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_TABLE[lane][part] * _powers(lane, len(part)), out=sums[1:])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            h = (sums[e] - sums[s]) * _powers(lane, len(part), True)[s]
            out[i:j] = mix(h + (e - s).astype(np.uint64) * _U(0xA24BAED4963EE407))
            i = j
        return out


def utf8(texts: list) -> list[bytes]:
    """UTF-8 of the texts; a null text has no bytes."""
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]


def split(raws: list[bytes], word_bytes: np.ndarray = WORD_BYTES, lower: bool = False) -> Words:
    """The words of every text, in order."""
    buf = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    if lower:
        buf = LOWER[buf]
    at = np.zeros(len(raws) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raws], out=at[1:])
    inside = np.zeros(len(buf) + 1, bool)
    inside[1:] = word_bytes[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    return Words(buf, at, start, end, np.searchsorted(start, at))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n entries from every position on (positions 0 to len - n).

    Built from blocks of doubling length, so n costs about log2(n) passes.
    """
    if len(h) < n:
        return np.empty(0, np.uint64)
    out, done, block, size = None, 0, h, 1
    left = n
    while True:
        if left & 1:
            piece = block[done:done + len(h) - n + 1]
            out = piece if out is None else mix(out * _U(0x9FB21C651E98DF25) + piece)
            done += size
        left >>= 1
        if not left:
            return out
        block = mix(block[:-size] * _U(0xC2B2AE3D27D4EB4F) + (block[size:] ^ _U(size)))
        size *= 2


def slices(texts: list, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)
