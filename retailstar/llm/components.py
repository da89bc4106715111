"""Connected components by star contraction, rounds of Spark joins.

Edges (a, b) of long ids; every round rewires each node to the smallest node it
can see (large star, then small star), written between rounds, until no edge
changes. Labels stay distributed; a node with very many edges is aggregated
map-side and only ever joined as the small side of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(
        F.col("m").alias("a"), "b").where("a != b").distinct()


def _small(e: DataFrame) -> DataFrame:
    # every edge points from its larger to its smaller end here
    d = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = d.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
    joined = d.join(least, F.col("u") == F.col("x"))
    return joined.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
        joined.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a != b").distinct()


def _state(e: DataFrame):
    return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component."""
    e = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
               .where("a != b").distinct(), "edges")
    state = _state(e)
    while state[0]:
        e = stored(_small(_large(e)), "edges")
        new = _state(e)
        if new == state:
            break
        state = new
    # stars now: every node hangs on its root
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
