r"""Mixing sources to target weights (6): Sainte-Lague apportionment.

Sizes are words `[^\x20\x09-\x0D]+`. Every source's target is its share of all
words by weight, held at ``max_repeats`` times its own words, the excess shared
again by weight (one multiplier, found by rounds of one small aggregate).
The targets are apportioned into blocks of ``block_words`` words: a source gets
as many blocks as quotients ``target / (2 k + 1)`` of it are among the highest,
and so does every shard within its source, by its words. A shard is a hash
bucket of a source's documents, small enough for one task whatever a source
holds. Within a shard the documents stand in seeded order on a line of words;
full turns of the line count once per document, the rest is a seeded run of
consecutive blocks.

All steps are DataFrame operations; the per-source table is never collected.
Highest quotients need no queue: for a divisor d a source has
``floor(target / d + 1/2)`` of them, so d is searched by bisection and the last
few seats go by quotient.

Defined results: a null text has size 0; null sources are one source, last in
order; a source without words has target 0; repeated rows are separate documents,
numbered, and any of them may stand for another; another layout of the same table
gives the same result; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import dense_number
from ..session import release_temporary
from .common import annotate, fresh, quoted, read_documents, stored
from . import words as W

BLOCK_WORDS = 16
WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
SHARD_ROWS = 2_000


def n_words(texts: list) -> dict:
    return {"size": W.split(W.utf8(texts)).counts}


def targets(sources: DataFrame, weight: Column, max_repeats: int) -> DataFrame:
    """(source_no, words, target) of (source_no, words): water filling by rounds."""
    s = sources.select("source_no", "words", weight.alias("w")).withColumn("cap", F.col("words") * F.lit(max_repeats))
    total = s.agg(F.sum("words")).first()[0] or 0
    rate = 0.0
    while True:
        # held at their cap at the present multiplier; the others share what is left
        held = F.col("cap") < F.lit(rate) * F.col("w")
        r = s.agg(F.sum(F.when(held, F.col("cap"))).alias("fixed"),
                  F.sum(F.when(~held, F.col("w"))).alias("weight")).first()
        new = (total - (r["fixed"] or 0)) / r["weight"] if r["weight"] else rate
        if new <= rate:
            break
        rate = new
    return s.select("source_no", "words", F.least(F.col("cap").cast("double"),
                                                  F.lit(rate) * F.col("w")).alias("target"))


def _seats(votes: str, divisor: Column) -> Column:
    return F.floor(F.col(votes) / divisor + F.lit(0.5)).cast("long")


def apportion(df: DataFrame, votes: str, total: int, out: str) -> DataFrame:
    """Sainte-Lague: ``total`` seats by highest quotients votes / (2 k + 1).

    Needs a column ``tie`` (unique) for equal quotients.
    """
    stat = df.agg(F.sum(votes).alias("v"), F.count(F.lit(1)).alias("n")).first()
    if not stat["v"] or total <= 0:
        return df.withColumn(out, F.lit(0).cast("long"))
    # seats(d) falls with d: find d with seats(d) <= total, as close as doubles allow
    v, half = stat["v"], stat["n"] / 2
    lo, hi = v / (total + half + 1), v / (total - half) if total > half else 4 * v
    for _ in range(60):
        mid = (lo + hi) / 2
        n = df.agg(F.sum(_seats(votes, F.lit(mid)))).first()[0]
        if n == total:
            hi = mid
            break
        lo, hi = (mid, hi) if n > total else (lo, mid)
        if hi - lo <= hi * 1e-12:
            break
    got = df.withColumn(out, _seats(votes, F.lit(hi)))
    left = total - got.agg(F.sum(out)).first()[0]
    if left > 0:
        # equal quotients at the border: by quotient, then by the tie column
        last = (got.withColumn("__q", F.col(votes) / (2 * F.col(out) + 1))
                .orderBy(F.desc("__q"), "tie").limit(left).select(F.col("tie").alias("__tie"), F.lit(1).alias("__one")))
        got = got.join(last, F.col("tie") == F.col("__tie"), "left").withColumn(
            out, F.col(out) + F.coalesce(F.col("__one"), F.lit(0))).drop("__tie", "__one")
    return got


def seats_within(df: DataFrame, group: str, votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague within every group at once: the highest quotients, out of those
    that the bounds on the group's divisor leave open (windows over its shards)."""
    w = Window.partitionBy(group)
    v = F.sum(votes).over(w)
    df = df.withColumn("__v", v).withColumn("__n", F.count(F.lit(1)).over(w))
    # the divisor that gives all seats lies between V / (S + n/2) and V / (S - n/2): at the
    # one too few seats are given, at the other too many; one more each way for rounding
    share, half = F.col(votes) / F.col("__v"), F.col("__n") / 2
    at = lambda s: F.floor(share * s + F.lit(0.5)).cast("long")
    least = F.when((F.col("__v") > 0) & (F.col(seats) > half), F.greatest(at(F.col(seats) - half) - 1, F.lit(0))).otherwise(F.lit(0))
    most = F.when(F.col("__v") > 0, at(F.col(seats) + half) + 1).otherwise(F.lit(0))
    df = df.withColumn("__low", least).withColumn("__high", F.greatest(most, F.col("__low")))
    df = df.withColumn("__rest", F.col(seats) - F.sum("__low").over(w))
    # every quotient that may be among the highest: 2 n + a few per group of n
    q = df.select("*", F.explode(F.sequence(F.col("__low"), F.col("__high"))).alias("__k"))
    q = q.withColumn("__q", F.col(votes) / (2 * F.col("__k") + 1))
    q = q.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("__q"), "tie")))
    taken = q.groupBy("tie").agg(F.sum(F.when((F.col("__r") <= F.col("__rest")) & (F.col("__v") > 0), 1)
                                       .otherwise(0)).alias("__got"))
    taken = taken.withColumnRenamed("tie", "__tie")
    return (df.join(taken, F.col("tie") == F.col("__tie"))
            .withColumn(out, F.col("__low") + F.col("__got"))
            .drop("__v", "__n", "__low", "__high", "__rest", "__tie", "__got"))


def numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``, 0, 1, ... among rows of equal content (column ``same``).

    Copies are counted per written file (bits of ``row``) and numbered within it, the
    counts of the files before are added: however many copies there are, no group is
    larger than a file or than the number of files."""
    file = rows.withColumn("file", F.shiftright("row", 33))
    per = file.groupBy(F.col("same").alias("c_same"), F.col("file").alias("c_file")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("c_same").orderBy("c_file").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("c_same", "c_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    own = file.withColumn("copy", F.row_number().over(Window.partitionBy("same", "file").orderBy("row")) - 1)
    return own.join(per, (F.col("same") == F.col("c_same")) & (F.col("file") == F.col("c_file"))).select(
        *rows.columns, (F.col("copy") + F.col("earlier")).alias("copy"))


def plan_mix(docs: DataFrame, keep: list[str], *, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS,
             block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: int = 7,
             also: list[str] | None = None) -> DataFrame:
    """``keep`` plus size, source_size, target, taken and copies of every row.

    Rows are ordered by id, source and text, and by the columns ``also``; only rows
    equal in all of these are told apart by where they were read.

    ``taken`` counts words; ``copies`` counts whole documents for a mix that
    does not cut any: full turns, and one more where the run covers the middle.
    """
    also = also or []
    named = docs.select(*[F.col(quoted(c)).alias(f"k__{i}") for i, c in enumerate(keep)],
                        F.col(quoted(id_col)).alias("id"), F.col(quoted(source_col)).alias("source"),
                        F.col(quoted(text_col)).alias("text"), *[F.col(quoted(c)).alias(f"o__{i}") for i, c in enumerate(also)])
    kept = [f"k__{i}" for i in range(len(keep))]
    # what a row is, wherever it is read
    content = F.md5(F.to_json(F.struct("id", "source", F.md5("text").alias("text"), *[f"o__{i}" for i in range(len(also))])))
    sized = annotate(named.withColumn("same", content), "text", {"size": "long"}, n_words, [*kept, "id", "source", "same"])
    # written twice: the first fixes where a row stands, the second is read by all that follows
    rows = stored(numbered_copies(stored(sized.withColumn("row", F.monotonically_increasing_id()), "mix-rows")), "mix-numbered")
    per = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    # one row per source; its number by code point, null last
    numbered = stored(dense_number(per, [F.col("source").asc_nulls_last()], "no_").select(
        "source", "words", "docs", (F.col("no_") - 1).alias("source_no")), "mix-sources")
    release_temporary(docs.sparkSession)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    goal = stored(targets(numbered, weight, max_repeats), "mix-targets")
    total = goal.agg(F.sum("target")).first()[0] or 0.0
    n_blocks = round(total / block_words)
    blocks = apportion(goal.withColumn("tie", F.col("source_no")), "target", n_blocks, "blocks").select(
        F.col("source_no").alias("no"), "target", "blocks")
    plan = numbered.join(blocks, F.col("source_no") == F.col("no")).select(
        F.col("source").alias("p_source"), "source_no", F.col("words").alias("source_size"), "target", "blocks",
        F.greatest(F.ceil(F.col("docs") / shard_rows), F.lit(1)).cast("long").alias("shards"))
    plan = stored(plan, "mix-plan")
    same = F.col("source").eqNullSafe(F.col("p_source"))
    # the plan has one row per source; the planner broadcasts it while it is small
    placed = rows.join(plan, same).withColumn("order", F.xxhash64(F.lit(seed), "same", "copy"))
    placed = placed.withColumn("shard", F.pmod(F.shiftright("order", 20), F.col("shards")))
    shard = placed.groupBy("source_no", "shard").agg(F.sum("size").alias("line"), F.first("blocks").alias("blocks"))
    shard = shard.withColumn("tie", F.struct("source_no", "shard"))
    quota = seats_within(shard, "source_no", "line", "blocks", "quota").select(
        F.col("source_no").alias("q_no"), F.col("shard").alias("q_shard"), "line", "quota")
    quota = stored(quota, "mix-quotas")
    d = placed.join(quota, (F.col("source_no") == F.col("q_no")) & (F.col("shard") == F.col("q_shard")))
    w = Window.partitionBy("source_no", "shard").orderBy("order", "same", "copy").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("at", F.coalesce(F.sum("size").over(w), F.lit(0)))
    want = F.least(F.col("quota") * block_words, F.col("line") * max_repeats)
    turns = F.when(F.col("line") > 0, F.floor(want / F.col("line"))).otherwise(F.lit(0)).cast("long")
    d = d.withColumn("turns", turns).withColumn("rest", want - F.col("turns") * F.col("line"))
    first = F.pmod(F.xxhash64(F.lit(seed + 1), "source_no", "shard"),
                   F.greatest(F.ceil(F.col("line") / block_words), F.lit(1))) * block_words
    d = d.withColumn("from", first).withColumn("to", F.col("from") + F.col("rest"))
    end = F.col("at") + F.col("size")

    def overlap(shift: Column) -> Column:
        return F.greatest(F.least(end + shift, F.col("to")) - F.greatest(F.col("at") + shift, F.col("from")), F.lit(0))

    # the run may pass the end of the line and go on at its start
    d = d.withColumn("taken", (F.col("turns") * F.col("size") + overlap(F.lit(0)) + overlap(F.col("line"))).cast("long"))
    mid = F.col("at") + F.floor(F.col("size") / 2)
    inside = ((mid >= F.col("from")) & (mid < F.col("to"))) | (
        (mid + F.col("line") >= F.col("from")) & (mid + F.col("line") < F.col("to")))
    d = d.withColumn("copies", (F.col("turns") + F.when(inside & (F.col("size") > 0), 1).otherwise(0)).cast("int"))
    return d.select(*[F.col(k).alias(c) for k, c in zip(kept, keep)],
                    "size", "source_size", "target", "taken", "copies")


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
                  text_col: str = "text", **kw) -> DataFrame:
    """The mixed documents, all columns unchanged: whole documents, repeated ones as rows.

    The plan is made of ids and sizes; texts are joined to it once at the end.
    """
    row = fresh("mix_row", docs)
    base = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    plan = plan_mix(base, [row], id_col=id_col, source_col=source_col, text_col=text_col,
                    also=[c for c in docs.columns if c not in (id_col, source_col, text_col)], **kw)
    plan = plan.where("copies > 0").select(F.col(row).alias(f"{row}_p"), F.col("copies").alias(f"{row}_n"))
    out = base.join(plan, F.col(row) == F.col(f"{row}_p")).withColumn(
        f"{row}_t", F.explode(F.sequence(F.lit(1), F.col(f"{row}_n"))))
    return out.select(*[quoted(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_mix(read_documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken")


__all__ = ["apportion", "mix_documents", "plan_mix", "query", "targets"]
