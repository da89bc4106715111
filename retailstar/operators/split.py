"""Exact seeded split.

``df.sample(frac, random_state)`` takes exactly ``round(frac * n)`` rows. Here
the rows are ranked by an engine-portable hash of all columns (then by the
columns themselves) and the first ``round(frac * n)`` ranks form the sample;
the rest is its complement. The
two parts are disjoint, complete, of exact size and the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from ..session import temporary_table
from .keys import dense_number

_RANK = "__split_rank"
_HASH = "__split_hash"


def split_key_order(columns: list[str]) -> list:
    return [F.col(_HASH).asc()] + [F.col(c).asc_nulls_first() for c in columns]


_BUCKET = "__split_bucket"
PREFIX_HEX = 4   # hash-prefix buckets for the boundary search: 16**4 = 65,536 counts


def label_split(df: DataFrame, frac: float, seed: int = 1, label: str = "part",
                sample_label: str = "sample", rest_label: str = "rest") -> DataFrame:
    """All rows with a ``label`` column naming the part each row belongs to.

    Rank order is (hash, columns); the first ``round(frac * n)`` ranks are the
    sample. Instead of sorting everything, the rows are counted per hash
    prefix (at most 65,536 counts, combined map-side); whole buckets before the
    one holding rank k are sample, those after it rest, and only the rows of
    that boundary bucket are numbered exactly, by the distributed numbering, so
    even a boundary bucket of copies holding a third of the rows is spread out.

    The rows are written once (a temporary table) for the count pass and the
    labelling pass. Both compute the hash, which no writer could compress.
    """
    cols = df.columns
    rows, _ = temporary_table(df, "to-split")
    kept = (rows.withColumn(_HASH, row_hash(*cols, seed=seed))
                .withColumn(_BUCKET, F.substring(_HASH, 1, PREFIX_HEX)))
    counts = sorted((r[_BUCKET], r["n"]) for r in
                    kept.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(c for _, c in counts)
    k = int(round(frac * n))                       # Python rounding, as the pandas sampler
    boundary, before = None, 0
    for b, c in counts:
        if before + c >= k and k > 0:
            boundary = b
            break
        before += c
    lab = lambda cond: F.when(cond, F.lit(sample_label)).otherwise(F.lit(rest_label)).alias(label)
    if boundary is None:                           # k == 0: everything is rest
        return kept.select(*cols, lab(F.lit(False)))
    edge = kept.filter(F.col(_BUCKET) == boundary)
    ranked = dense_number(edge, split_key_order(cols), _RANK)
    edge_part = ranked.select(*cols, lab(F.col(_RANK) <= k - before))
    # an expression that cannot be moved: else the hash is computed for the filter and again for the label
    fixed = kept.withColumn(_BUCKET, F.when(F.monotonically_increasing_id() >= 0, F.col(_BUCKET)))
    other = fixed.filter(F.col(_BUCKET) != boundary).select(*cols, lab(F.col(_BUCKET) < boundary))
    return other.unionByName(edge_part)


def split_exact(df: DataFrame, frac: float, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(sample, rest): ``rest`` is the complement of ``sample``."""
    labelled = label_split(df, frac, seed)
    cols = df.columns
    return (labelled.filter(F.col("part") == "sample").select(*cols),
            labelled.filter(F.col("part") == "rest").select(*cols))
