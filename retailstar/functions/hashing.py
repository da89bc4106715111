"""Deterministic, engine-portable hashing (X10, O5 ordering).

``md5`` over a ``|``-joined text form of the columns gives the same value in
Spark and in any SQL engine with ``md5``/``concat_ws``, so random-looking
choices (the 80:20 split, synthetic flags) are reproducible and checkable.
Numeric columns should be decimal or integer so their text form is the same
everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(*cols: str | Column, seed: int | str = 0) -> Column:
    parts = [F.lit(str(seed))] + [
        (F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_flag(*cols: str | Column, seed: int | str = 0, threshold_hex: str = "66") -> Column:
    """1 when the first two hex digits of the hash are below ``threshold_hex``.

    '66' = 102/256, about 0.4: the deterministic stand-in for ``rand() < 0.4``.
    """
    h = row_hash(*cols, seed=seed)
    return F.when(F.substring(h, 1, len(threshold_hex)) < F.lit(threshold_hex), 1).otherwise(0)
