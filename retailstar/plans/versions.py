"""Versions of dimension members over several loads.

A load brings the members as they are now. Next to the dimension's last versions
each member is unchanged, changed, new or not there; a change closes the open
version at the load's moment and opens the next one. All of it is one null-safe
outer join on the business key, with the change told by a hash of the tracked
columns; closed versions of former loads pass it untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import extend_keys, same_key
from ..operators.quality import ExpectationError
from ..session import temporary_table
from .dimensions import Dimension, moment, VALID_FROM


def change_hash(cols: list[Column]) -> Column:
    """A hash of named columns; a null differs from every text."""
    return F.md5(F.to_json(F.struct(*cols)))


def valid_at(at: Column) -> Column:
    """The version that was valid at a moment (start included, end not)."""
    return (F.col("date_from") <= at) & (F.col("date_to").isNull() | (at < F.col("date_to")))


def next_versions(dim: Dimension, table: DataFrame, members: DataFrame, load_ts, *,
                  key: tuple[str, ...] | None = None, missing: str = "keep",
                  overwrite: Column | None = None) -> DataFrame:
    """``table`` (all versions so far) after a load of ``members`` at ``load_ts``.

    ``key``: the business key over time (default: the dimension's); the other
    business and told columns are tracked. The source id is no version of its own: a
    member that gets one later gets it in all that is written of its last version.
    A new member starts at VALID_FROM, so every moment has exactly one version.
    ``missing='close'`` closes a member that is not loaded; one that comes back gets
    a new version. ``overwrite``: last versions for which this holds take a change
    in place, as does a version opened by the same load (a load that is run again).
    A load older than an open version fails.
    """
    if missing not in ("keep", "close"):
        raise ValueError(f"missing is {missing!r}")
    by = list(key or dim.business)
    tracked = [c for c in (*dim.business, *dim.told) if c not in by]
    ts = moment(load_ts)
    # read by the check and by the join
    members, _ = temporary_table(members, "members")
    repeated = members.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if repeated:
        raise ExpectationError(f"{dim.key}: the load has a business key twice, e.g. {repeated[0]}")
    if table.where(F.col("date_to").isNull() & (F.col("date_from") > ts)).limit(1).collect():
        raise ExpectationError(f"{dim.key}: the load is older than a version that is open")
    last = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("version"))) == 1
    old = table.withColumn("__last", last)
    # told of an old row, asked of the row itself
    old = old.withColumn("__place", F.coalesce(overwrite, F.lit(False)) if overwrite is not None else F.lit(False))
    new = members.select(*[F.col(c).alias(f"__in_{c}") for c in dim.members], F.lit(True).alias("__in"))
    both = old.join(new, same_key(old, new, by, "__in_") & old["__last"], "full_outer")

    incoming = {c: F.col(f"__in_{c}") for c in dim.members}
    own_id = F.coalesce(incoming[dim.source_id], F.col(dim.source_id))
    open_ = F.col("date_to").isNull()
    same = change_hash([F.col(c).alias(c) for c in tracked]) == change_hash(
        [incoming[c].alias(c) for c in tracked]) if tracked else F.lit(True)

    def row(**changed: Column) -> Column:
        return F.struct(*[changed.get(c, F.col(c)).cast(t).alias(c) for c, t in table.dtypes])

    extra = {c: F.lit(None) for c in table.columns if c not in dim.columns}
    first = row(**{dim.key: F.lit(None)}, version=F.lit(1), date_from=moment(VALID_FROM), date_to=F.lit(None), **incoming, **extra)
    opened = row(**{dim.key: F.lit(None)}, version=F.col("version") + 1, date_from=ts, date_to=F.lit(None),
                 **incoming | {dim.source_id: own_id}, **extra)
    stays = row()
    known = row(**{dim.source_id: own_id})
    placed = row(**incoming | {dim.source_id: own_id}, **extra)
    closed = row(date_to=ts)
    gone = F.array(closed) if missing == "close" else F.array(stays)
    rows = (F.when(F.col("version").isNull(), F.array(first))
            .when(F.col("__in").isNull(), F.when(F.col("__last") & open_ & (F.col("date_from") < ts), gone).otherwise(F.array(stays)))
            .when(open_ & same & ~F.col("__place"), F.array(known))
            .when(F.col("__place") | (open_ & (F.col("date_from") == ts)), F.array(placed))
            .when(open_, F.array(closed, opened))
            .otherwise(F.array(stays, opened)))
    out = both.select(F.explode(rows).alias("r")).select("r.*")
    return extend_keys(out, dim.key, list(dim.order))
