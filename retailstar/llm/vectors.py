"""Vectors as exact integers, and Arrow columns of them as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: components stay below this, so every inner product of 1,024 components is exact in 64 bits
LIMIT = 1 << 26


def finite(vector: Column) -> Column:
    """True if the vector is there and no component is null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; one beyond LIMIT fails the job,
    since its products would not be exact."""
    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(y) < F.lit(LIMIT), y.cast("int")).otherwise(
            F.raise_error(F.lit(f"a vector component is not below {LIMIT} once scaled")).cast("int"))
    return F.transform(vector, whole)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of ``dims`` 64-bit integers; shorter rows end in zeros."""
    n = len(column)
    lengths = np.diff(column.offsets.to_numpy()[:n + 1])
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == dims).all():
        return flat.reshape(n, dims)
    out = np.zeros((n, dims), np.int64)
    out[np.repeat(np.arange(n), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two integer matrices' rows, exact: by floating point
    while every partial sum is below 2**53, in integers otherwise."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if top < 2 ** 53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def up_root(squares: np.ndarray | int) -> np.ndarray:
    """The least integer whose square is at least the given one."""
    squares = np.asarray(squares, np.int64)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64) + 2
    for _ in range(4):
        root -= (root > 0) & ((root - 1) * (root - 1) >= squares)
    return root
