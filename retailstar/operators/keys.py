"""Surrogate keys (W1, W2) and name -> id mapping.

``dense_number`` is ``row_number() OVER (ORDER BY ...)`` without the single
partition a global window needs, by one path for inputs of any size:

1. the rows are written; from then on a row's place in its file is a fixed
   tiebreak, the same in every retry of a task;
2. they are range-partitioned on the order key, then on all other columns, then
   on the tiebreak, sorted inside each range and written with their position.
   The number of ranges follows the bytes written in step 1 (``ranges_for``). A group of
   identical rows, even a third of the input, is spread over several ranges;
3. the rows per range (one number per range) shift each position.

Order columns that come in few combinations (``together``) go through the shuffle
as one number, their combination's place.

Rows that differ are ordered by their content alone, so the input's row order
does not matter; identical rows are interchangeable.
"""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions, temporary_table, written_bytes
from .dedup import distinct_rows
from .joins import lookup_join

_TIE = "__rs_tie"
_MID = "__rs_mid"
_RANGE = "__rs_range"
_OFF = "__rs_off"
_PLACE = "__rs_place"
_POS_BITS = 33  # monotonically_increasing_id keeps the partition index above bit 33
#: written bytes (compressed) that one range sorts; a smaller table is dealt to the
#: session's shuffle partitions down to LEAST_BYTES each, a larger one to MAX_RANGES
RANGE_BYTES, LEAST_BYTES, MAX_RANGES = 256 << 20, 1 << 20, 50_000
#: combinations of columns that one place stands for; with more, the columns themselves are sorted
MOST_PLACES = 100_000


def sort_spec(o: str | Column) -> Column:
    """Strings sort ascending with nulls first (Spark's default for ASC)."""
    return F.col(o).asc_nulls_first() if isinstance(o, str) else o


def ranges_for(size: int, at_hand: int) -> int:
    """How many ranges a table of ``size`` written bytes is sorted in. The driver adds
    up one count per range, so their number is bounded; beyond, ranges grow."""
    return max(1, min(MAX_RANGES, max(math.ceil(size / RANGE_BYTES), min(at_hand, math.ceil(size / LEAST_BYTES)))))


def numbered_with_total(df: DataFrame, order: list, out: str = "rn", *, partitions: int | None = None,
                        out_type: str = "long", together: list[str] | None = None,
                        places: tuple[DataFrame, int] | None = None) -> tuple[DataFrame, int]:
    """``dense_number`` plus the number of rows."""
    spark = df.sparkSession
    cols = df.columns
    rows, path = temporary_table(df, "to-number")
    n_ranges = partitions or ranges_for(written_bytes(spark, path), shuffle_partitions(spark))
    tied = rows.withColumn(_TIE, F.monotonically_increasing_id())
    if together:
        at = order.index(together[0])
        if order[at:at + len(together)] != together:
            raise ValueError(f"{together} do not follow each other in {order}")
        ordered, n = places or numbered_with_total(distinct_rows(rows, together), together, _PLACE)
        if n > MOST_PLACES:
            together = None
        else:   # at most MOST_PLACES rows
            ordered = ordered.toDF(*together, _PLACE) if places else temporary_table(ordered, "places")[0]
            small = F.broadcast(ordered)
            tied, order = placed(tied, small, together), [*order[:at], _PLACE, *order[at + len(together):]]
    keys = ([sort_spec(o) for o in order] + [F.col(f"`{c}`").asc_nulls_first() for c in cols if c not in (together or [])]
            + [F.col(_TIE)])
    staged = (tied.repartitionByRange(n_ranges, *keys).sortWithinPartitions(*keys)
              .withColumn(_MID, F.monotonically_increasing_id()).drop(_TIE))
    if together:
        staged = placed(staged, small, [_PLACE]).select(*cols, _MID)
    stored, _ = temporary_table(staged, "numbered")
    stored = stored.withColumn(_RANGE, F.shiftright(F.col(_MID), _POS_BITS))
    sizes = stored.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, run = [], 0
    for r in sorted(sizes, key=lambda r: r[_RANGE]):
        offsets.append((int(r[_RANGE]), run))
        run += int(r["n"])
    # as an Arrow table it reaches the executors without Python workers of its own
    off_df = spark.createDataFrame(pa.table({_RANGE: pa.array([r for r, _ in offsets], pa.int64()),
                                             _OFF: pa.array([o for _, o in offsets], pa.int64())}))
    pos = F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    # one row per range, at most MAX_RANGES
    numbered = (stored.join(F.broadcast(off_df), _RANGE)
                .withColumn(out, (F.col(_OFF) + pos + 1).cast(out_type)))
    return numbered.select(*cols, out), run


def dense_number(df: DataFrame, order: list, out: str = "rn", *, partitions: int | None = None,
                 out_type: str = "long", together: list[str] | None = None,
                 places: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Add ``out`` = 1..n in the given order, ties by the other columns.

    ``together``: names that follow each other in ``order``, few combinations of which
    occur; they are put in order by themselves and the rows shuffled with one number
    in their place. Beyond MOST_PLACES combinations the rows keep the columns.
    ``places``: a written table of all combinations with their number as its last
    column, and its rows, where they have been put in order before."""
    return numbered_with_total(df, order, out, partitions=partitions, out_type=out_type, together=together, places=places)[0]


def add_surrogate_key(df: DataFrame, order: list, key: str, first: bool = True,
                      out_type: str = "long") -> DataFrame:
    """Dense key over the given order; key column first by default."""
    numbered = dense_number(df, order, key, out_type=out_type)
    rest = [c for c in numbered.columns if c != key]
    return numbered.select(key, *rest) if first else numbered


def extend_keys(df: DataFrame, key: str, order: list) -> DataFrame:
    """W1 over several loads: rows without a ``key`` get the numbers after the largest
    one, in the given order; a row that has one keeps it."""
    rows, _ = temporary_table(df, "to-extend")
    kind = dict(df.dtypes)[key]
    about = rows.agg(F.max(key).alias("last"), F.count(F.lit(1)).alias("n"), F.count(key).alias("keyed")).first()
    if about["n"] == about["keyed"]:
        return rows
    last = about["last"] or 0
    new = dense_number(rows.where(F.col(key).isNull()).drop(key), order, key)
    return rows.where(F.col(key).isNotNull()).unionByName(
        new.withColumn(key, (F.col(key) + F.lit(last)).cast(kind)).select(*df.columns))


def same_key(left: DataFrame, right: DataFrame, cols: list[str], prefix: str) -> Column:
    """Null-safe equality of ``cols`` with the right side's ``prefix`` + column."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in cols])


def placed(rows: DataFrame, places: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``places`` instead of ``names``, which are
    all there."""
    found = places.withColumnsRenamed({c: f"__at_{c}" for c in names})
    return lookup_join(rows, found, same_key(rows, found, names, "__at_")).drop(*names, *[f"__at_{c}" for c in names])


def with_stable_keys(previous: DataFrame, incoming: DataFrame, key: list[str], order: list, id_col: str = "id") -> DataFrame:
    """J12 over several loads: the rows of ``previous`` (a table with ids, the registry
    of its business keys) and of ``incoming`` (the same columns without the id).

    A known business key keeps its id and takes the incoming values, a new one is
    numbered after the largest id, one that is not incoming stays as it is. One
    null-safe outer join; a business key may come once in ``incoming``."""
    rest = [c for c in previous.columns if c != id_col]
    new = incoming.select(*[F.col(c).alias(f"__in_{c}") for c in rest], F.lit(True).alias("__in"))
    both = previous.join(new, same_key(previous, new, key, "__in_"), "full_outer")
    told = [F.when(F.col("__in"), F.col(f"__in_{c}")).otherwise(F.col(c)).alias(c) for c in rest]
    return extend_keys(both.select(id_col, *told).select(*previous.columns), id_col, order)


def id_map(df: DataFrame, name_cols: list[str], id_col: str = "id") -> DataFrame:
    """J12 build: (names..., id) with one id per name tuple (lowest id wins,
    as a dict keyed by name would keep one value)."""
    return df.groupBy(*name_cols).agg(F.min(id_col).alias(id_col))


def map_ids(df: DataFrame, mapping: DataFrame, left_on: list[str], right_on: list[str],
            id_col: str, out: str) -> DataFrame:
    """J12 apply: left join to a deduplicated (names, id) map; a miss gives null."""
    m = id_map(mapping, right_on, id_col)
    m = m.select(*[F.col(r).alias(f"__map_{i}") for i, r in enumerate(right_on)],
                 F.col(id_col).alias(out))
    cond = [df[l] == m[f"__map_{i}"] for i, l in enumerate(left_on)]
    joined = lookup_join(df, m, cond, "left")
    return joined.drop(*[f"__map_{i}" for i in range(len(right_on))])
