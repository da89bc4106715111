"""Sharding (2): balanced label propagation.

Documents with equal text are linked. Every document starts in a shard of an
exactly even spread; rounds of joins then move linked documents to the shard
where most of their neighbours are. The members of a group that share a shard
move alike, so a round works on cells (group, shard, count) instead of pairs or
documents. Moves into a shard are held under its capacity: the wishes are
counted per (from, to, hash slot of the group), a table of fixed size, and each
shard takes the slots that fit, counting what leaves it (the flows are lowered
until no shard is over its capacity). Documents without a link fill what is
left, so the law ``rows`` holds exactly: counts differ by one at most.

Where the rounds leave a cluster whole, it stays. A cluster whose label (the shard
that holds most of it) never had room would stay scattered, so these are settled,
largest first, whole, in the room that is left: in their label, else in another
shard. Small ones go in bundles, so that a table of fixed size decides; refused
bundles are dealt anew, smaller, until single clusters are left. What fits nowhere
whole is cut, over as few shards as the room left allows; only if something must be
cut, the whole clusters are settled anew with the others, and that counts if it
cuts fewer documents.

A group larger than a shard's capacity is first cut by hash into clusters of
half a capacity; clusters, not groups, are kept together then.

Defined results: a null text has size 16 and CRC 0, and null texts are equal;
repeated rows are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces, ranked, read_documents, stored

N_SHARDS = 40
#: rounds end as soon as no document wishes to move, or STUCK rounds moved none
ROUNDS = 24
STUCK = 3
SLOTS = 64
#: a group with this share of all rows is hot: there are at most as many such groups
HOT = 1_000


def _accepted(wishes: list[tuple[int, int, int, int]], load: list[int], cap: list[int]) -> list[int]:
    """For every shard, the number of hash slots whose wishes it takes.

    ``wishes``: (from, to, slot, documents), at most shards * shards * SLOTS
    rows. Starts with all; a shard that would go over its capacity gives up one
    slot at a time. That also lowers what leaves others, so it repeats until
    all fit (no move at all always fits).
    """
    k = len(cap)
    flow = np.zeros((k, k, SLOTS + 1), np.int64)
    for s, t, u, n in wishes:
        flow[s, t, u + 1] += n
    flow = flow.cumsum(axis=2)
    take = np.full(k, SLOTS)
    load_, cap_, at = np.array(load), np.array(cap), np.arange(k)
    while True:
        moves = flow[:, at, take]
        after = load_ + moves.sum(axis=0) - moves.sum(axis=1)
        over = (after > cap_) & (take > 0)
        if not over.any():
            return take.tolist()
        take = take - over


def propagate(cells: DataFrame, load: list[int], cap: list[int], rounds: int = ROUNDS) -> tuple[DataFrame, list[int]]:
    """Rounds over (g, part, s0, s, n); returns the cells with final ``s`` and the loads."""
    cluster = ["g", "part"]
    stuck = 0
    for i in range(rounds):
        there = cells.groupBy(*cluster, "s").agg(F.sum("n").alias("n"))
        # most neighbours; equal numbers by a hash that differs between groups
        best = there.groupBy(*cluster).agg(F.max(F.struct(
            "n", F.xxhash64("g", "part", "s").alias("h"), "s")).alias("b")).select(
            F.col("g").alias("bg"), F.col("part").alias("bp"), F.col("b.s").alias("t"))
        slot = F.pmod(F.xxhash64(F.lit(i), "g", "part"), F.lit(SLOTS)).cast("int")
        wish = cells.join(best, (F.col("g") == F.col("bg")) & (F.col("part") == F.col("bp"))).select(
            "g", "part", "s0", "s", "n", "t", slot.alias("u"))
        wish = stored(wish, "shard-wishes")
        table = [tuple(r) for r in wish.where("s != t").groupBy("s", "t", "u").agg(F.sum("n")).collect()]
        if not table:
            break
        take = _accepted(table, load, cap)
        moved = 0
        for s, t, u, n in table:
            if u < take[t]:
                load[t] += n
                load[s] -= n
                moved += n
        limit = F.element_at(F.array(*map(F.lit, take)), F.col("t") + 1)
        cells = wish.withColumn("s", F.when(F.col("u") < limit, F.col("t")).otherwise(F.col("s"))).select(
            "g", "part", "s0", "s", "n")
        stuck = 0 if moved else stuck + 1
        if stuck == STUCK:
            break
    return cells, load


def _placed(units: list[tuple[int, int, bool]], room: list[int]) -> tuple[list[int], list[int]]:
    """A shard for every unit (documents, label, single cluster), -1 if none has room,
    and the room then left. Largest first; of three rules the one that refuses least."""
    order = sorted(range(len(units)), key=lambda i: -units[i][0])
    best = None
    for label, emptiest in ((True, True), (True, False), (False, False)):
        left, to = list(room), [-1] * len(units)
        for i in order:
            n, t, _ = units[i]
            if not (label and left[t] >= n):
                fits = [s for s in range(len(left)) if left[s] >= n]
                if not fits:
                    continue
                t = max(fits, key=left.__getitem__) if emptiest else min(fits, key=left.__getitem__)
            to[i] = t
            left[t] -= n
        # a refused single cluster is cut, a refused bundle is dealt anew
        refused = (sum(u[0] for u, s in zip(units, to) if s < 0 and u[2]), sum(u[0] for u, s in zip(units, to) if s < 0))
        if best is None or refused < best[0]:
            best = refused, to, left
    return best[1], best[2]


def place_clusters(cells: DataFrame, load: list[int], cap: list[int]) -> tuple[DataFrame, list[int], int]:
    """(g, part, s) of every cluster after the rounds, ``s`` null where it must be cut; the
    loads, and the documents to cut."""
    cells, load = propagate(cells, load, cap)
    at = stored(cells.groupBy("g", "part").agg(F.min("s").alias("s"), F.max("s").alias("z"), F.sum("n").alias("m")),
                "shard-propagated")
    whole = at.where("s = z")
    taken = [0] * len(cap)
    for r in whole.groupBy("s").agg(F.sum("m").alias("m")).collect():
        taken[r["s"]] = r["m"]
    apart = at.where("s < z").select(F.col("g").alias("ag"), F.col("part").alias("ap"))
    rest, more, cut = settle(cells.join(apart, (F.col("g") == F.col("ag")) & (F.col("part") == F.col("ap"))),
                             [c - t for c, t in zip(cap, taken)])
    if cut:
        anew = settle(cells, cap)
        if anew[2] < cut:
            return anew
    return whole.select("g", "part", "s").union(rest), [t + m for t, m in zip(taken, more)], cut


def settle(cells: DataFrame, cap: list[int]) -> tuple[DataFrame, list[int], int]:
    """(g, part, s) of every cluster, ``s`` null if it fits nowhere whole; the loads, and
    the documents of clusters to cut.

    A round sends at most ``2 * SLOTS`` units a shard to the driver. Bundles are small
    against the room that is left, so each round leaves a small part of the one before.
    """
    spark, units = cells.sparkSession, SLOTS * len(cap)
    there = cells.groupBy("g", "part", "s").agg(F.sum("n").alias("n"))
    left = stored(there.groupBy("g", "part").agg(
        F.max(F.struct("n", F.xxhash64("g", "part", "s").alias("h"), "s")).alias("b"), F.sum("n").alias("m")).select(
        "g", "part", "m", F.col("b.s").alias("t")), "shard-clusters")
    room, cut, done, i = list(cap), 0, [], 0
    while True:
        stat = left.agg(F.count(F.lit(1)).alias("k"), F.sum("m").alias("m")).first()
        if not stat["k"]:
            break
        big = 0 if stat["k"] <= units else -(-stat["m"] // units)
        single = F.col("m") >= big
        slot = F.col("t") * SLOTS + F.pmod(F.xxhash64(F.lit(i), "g", "part"), F.lit(SLOTS))
        keyed = left.withColumn("single", single).withColumn(
            "unit", F.when(single, F.xxhash64("g", "part")).otherwise(slot))
        table = keyed.groupBy("single", "unit").agg(F.sum("m").alias("m"), F.min("t").alias("t")).collect()
        table.sort(key=lambda r: (r["single"], r["unit"]))
        to, room = _placed([(r["m"], r["t"], r["single"]) for r in table], room)
        cut += sum(r["m"] for r, s in zip(table, to) if s < 0 and r["single"])
        where = spark.createDataFrame([(r["single"], r["unit"], s) for r, s in zip(table, to)],
                                      "u_single boolean, u_unit long, s int")
        got = stored(keyed.join(F.broadcast(where), (F.col("single") == F.col("u_single")) & (
            F.col("unit") == F.col("u_unit"))).select("g", "part", "m", "t", "s", "single"), "shard-settled")
        done.append(got.where("s >= 0 OR single").select("g", "part", F.when(F.col("s") >= 0, F.col("s")).alias("s")))
        left = got.where("s < 0 AND NOT single").select("g", "part", "m", "t")
        i += 1
    if not done:
        return left.select("g", "part", F.col("t").alias("s")), [0] * len(cap), 0
    return reduce(DataFrame.union, done), [c - r for c, r in zip(cap, room)], cut


def shard_documents(docs: DataFrame, *, n_shards: int = N_SHARDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.col(text_col)
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(raw) + F.lit(16)).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
        F.unhex(F.sha2(F.when(text.isNull(), F.encode(F.lit("\0null"), "UTF-8")).otherwise(raw), 256)).alias("g"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    n = rows.count()
    cap = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]
    least = max(1, n // n_shards)
    half = max(1, least // 2)
    groups = stored(rows.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(
        F.col("g").alias("lg"), "m", F.when(F.col("m") <= least, 1).otherwise(F.ceil(F.col("m") / half)).cast("long").alias("parts")),
        "shard-groups")
    # rows of hot groups are not shuffled: at most HOT groups are broadcast
    is_hot = F.col("m") * HOT >= n
    hot, cold = groups.where(is_hot), groups.where(~is_hot)
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(F.lit(1), "row"), F.col("parts"))).alias("part")
    same = F.col("g") == F.col("lg")
    cols = ["doc_id", "size", "text_crc32", "g", "row", part]
    tagged = stored(rows.join(F.broadcast(hot), same).select(*cols).union(
        rows.join(F.broadcast(hot), same, "left_anti").join(cold, same, "left").select(*cols)), "shard-tagged")
    n_linked = tagged.where("part IS NOT NULL").count()
    start = ranked(tagged.where("part IS NOT NULL"), "row", n_linked, "r").withColumn(
        "s0", F.pmod("r", F.lit(n_shards)).cast("int"))
    linked = stored(start, "shard-linked")
    load = [n_linked // n_shards + (s < n_linked % n_shards) for s in range(n_shards)]
    cells = stored(linked.groupBy("g", "part", "s0").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "s", F.col("s0")).select("g", "part", "s0", "s", "n"), "shard-cells")
    settled, load, n_cut = place_clusters(cells, load, cap)
    settled = settled.select(F.col("g").alias("sg"), F.col("part").alias("sp"), "s")
    final = cells.drop("s").join(settled, (F.col("g") == F.col("sg")) & (F.col("part") == F.col("sp"))).select(
        F.col("g").alias("cg"), F.col("part").alias("cp"), F.col("s0").alias("c0"), "s")
    a = linked.join(final, (F.col("g") == F.col("cg")) & (F.col("part") == F.col("cp")) & (F.col("s0") == F.col("c0")))
    # the rest goes where room is left, most of it first: cut clusters one after another, then
    # documents without a link in hash order
    by_room = sorted(range(n_shards), key=lambda s: load[s] - cap[s])
    bound, bounds = 0, []
    for s in by_room:
        bound += cap[s] - load[s]
        bounds.append(bound)
    fill = F.element_at(F.array(*map(F.lit, by_room)), F.size(F.filter(
        F.array(*[F.lit(x).cast("long") for x in bounds]), lambda x: x <= F.col("r"))) + 1)
    b = ranked(tagged.where("part IS NULL"), "row", n - n_linked, "r").withColumn("r", F.col("r") + n_cut).withColumn("s", fill)
    if n_cut:
        c = a.where("s IS NULL").withColumn("z", F.xxhash64("g", "part")).withColumn(
            "y", F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(SLOTS)))
        ahead = Window.orderBy("cz", "cy").rowsBetween(Window.unboundedPreceding, -1)
        shift = c.groupBy(F.col("z").alias("cz"), F.col("y").alias("cy")).agg(F.count(F.lit(1)).alias("c")).select(
            "cz", "cy", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("o"))
        c = c.withColumn("k", F.row_number().over(Window.partitionBy("z", "y").orderBy("row")))
        c = c.join(shift, (F.col("z") == F.col("cz")) & (F.col("y") == F.col("cy"))).withColumn(
            "r", F.col("o") + F.col("k") - 1).withColumn("s", fill)
        rest = ["doc_id", "size", "text_crc32", "row", "s"]
        a, b = a.where("s IS NOT NULL"), b.select(*rest).union(c.select(*rest))
    cols = ["doc_id", "size", "text_crc32", "row", F.col("s").cast("int").alias("shard")]
    per = pieces(n, 1_000)
    placed = stored(a.select(*cols).union(b.select(*cols)).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(2), "row"), F.lit(per))), "shard-placed")
    before = Window.partitionBy("os").orderBy("ob").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy(F.col("shard").alias("os"), F.col("bucket").alias("ob")).agg(
        F.count(F.lit(1)).alias("c")).select("os", "ob", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("o"))
    within = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("row"))
    return placed.withColumn("k", within).join(
        offset, (F.col("shard") == F.col("os")) & (F.col("bucket") == F.col("ob"))).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("o") + F.col("k") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_documents(spark, sf_dir))
