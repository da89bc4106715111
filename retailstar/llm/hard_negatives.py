"""Hard-negative mining (12): inverted multi-index.

Vectors are cut into two halves, each half has a codebook, and a row's cell is
the pair of its nearest codewords. A codeword's radius is the largest distance
of a member's half from it, so ``q1 c1 + |q1| r1 + q2 c2 + |q2| r2`` is at least
the score of every row of cell (c1, c2) for the anchor q. Both codebooks are
sorted by their halves of the bound, and a heap walks the pairs from the highest
sum down. The walk ends, for certain and not by a count, where the bound falls
under the score that a row still needs: cells beyond it hold nothing that could
enter the anchor's list.

Search is two walks over written tables. The first looks at the cells of some
thousand rows and so finds a score that later rows must reach; the second goes
on from there until the bound falls under it. Positives are searched first
(five best of the label), then, for every different positive score t, the five
best rows of other labels in the window [low t, high t]; no cell whose bound is
under all windows is visited.

Cells are kept in blocks of a few thousand rows, and an anchor's visit goes to
every block of its cell: a cell with a third of all rows is many blocks, each
met in a row of its own by up to some hundred anchors (one matrix product).
Each such meeting returns at most five rows per anchor and window, and the
lists are cut again before they are shuffled (rank limit of the window). No
pair of rows is ever written.

The codebooks are fitted on at most ``SAMPLE`` rows (by id hash), every row is
indexed. Bounds are integers rounded up, scores are exact. Codewords, radii and
rows per cell are on the driver: at most 2 x 256 codewords, 65,536 cells.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; a scaled component of 2**26 or more fails the job; a
shorter vector counts as followed by zeros; repeated rows are rows of their own
(an anchor's copy is another row); equal scores go by smaller id; fewer rows
than asked for give all there are; an empty table or one without anchors gives
an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import prepare, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: the window of negative scores in percent of the positive's score
LOW, HIGH = 80, 100
#: rows that fit the codebooks at most
SAMPLE = 20_000
#: rows a cell should hold, and codewords per half at most
CELL_ROWS, MAX_CODES = 1_024, 256
#: rows of a cell that meet anchors at once, anchors that meet them
BLOCK_ROWS, BATCH_ANCHORS = 4_096, 256
#: rows the first walk looks at before it asks what is needed
FIRST_ROWS = 4_096
NONE = np.iinfo(np.int64).min


def codebook(halves: np.ndarray, codes: int, rounds: int = 6, seed: int = 11) -> np.ndarray:
    """At most ``codes`` integer codewords of a bounded sample's halves."""
    points = np.unique(halves, axis=0)
    if len(points) <= codes:
        return points
    words = points[np.sort(np.random.default_rng(seed).choice(len(points), codes, replace=False))].astype(np.float64)
    for _ in range(rounds):
        own = nearest(points, words)
        count = np.bincount(own, minlength=codes)
        for d in range(points.shape[1]):
            total = np.bincount(own, weights=points[:, d], minlength=codes)
            words[:, d] = np.where(count > 0, total / np.maximum(count, 1), words[:, d])
    return np.unique(np.rint(words).astype(np.int64), axis=0)


def nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    w = words.astype(np.float64)
    return ((w * w).sum(axis=1)[None, :] - 2.0 * (points.astype(np.float64) @ w.T)).argmin(axis=1)


@dataclass
class Index:
    """Codebooks, radii and rows per cell: all that a walk needs to know."""

    first: np.ndarray
    second: np.ndarray
    radius: tuple[np.ndarray, np.ndarray]
    #: rows of a cell, and the largest distances of its own members' halves
    cells: dict[tuple[int, int], tuple[int, int, int]]
    dims: int

    @property
    def cut(self) -> int:
        return (self.dims + 1) // 2

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per codeword of each half, the most that a member's half can score."""
        out = []
        for half, words, radius in ((q[:self.cut], self.first, self.radius[0]),
                                    (q[self.cut:], self.second, self.radius[1])):
            out.append(words @ half + V.up_root((half * half).sum()) * radius)
        return out[0], out[1]

    def cell_bound(self, q: np.ndarray) -> Callable[[int, int], int]:
        """The most that a row of one cell can score, by the cell's own radii."""
        a, b = self.first @ q[:self.cut], self.second @ q[self.cut:]
        n1, n2 = [int(V.up_root((h * h).sum())) for h in (q[:self.cut], q[self.cut:])]

        def most(c1: int, c2: int) -> int:
            _, r1, r2 = self.cells[c1, c2]
            return int(a[c1]) + int(b[c2]) + n1 * r1 + n2 * r2
        return most

    def walk(self, q: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(bound, c1, c2) of all cells that hold rows, highest bound first. The
        bound is that of the codewords' radii, so it falls along the walk."""
        u, v = self.bounds(q)
        a, b = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
        u, v = u[a].tolist(), v[b].tolist()
        heap = [(-(u[0] + v[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = int(a[i]), int(b[j])
            if cell in self.cells:
                yield -bound, *cell
            # every pair has one pair before it: (i, 0) follows (i - 1, 0), (i, j) follows (i, j - 1)
            if j == 0 and i + 1 < len(u):
                heapq.heappush(heap, (-(u[i + 1] + v[0]), i + 1, 0))
            if j + 1 < len(v):
                heapq.heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))


def build_index(rows: DataFrame, dims: int, total: int) -> tuple[DataFrame, Index]:
    """The rows with their cells, and the index over them."""
    cut = (dims + 1) // 2
    codes = min(MAX_CODES, max(2, math.ceil(math.sqrt(total / CELL_ROWS))))
    sample = rows.select("vector", F.xxhash64("id").alias("h")).orderBy("h", "vector").limit(SAMPLE).select("vector")
    points = np.zeros((0, dims), np.int64)
    got = sample.toArrow().column("vector").combine_chunks()
    if len(got):
        points = V.matrix(got, dims)
    first, second = codebook(points[:, :cut], codes), codebook(points[:, cut:], codes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = V.matrix(batch.column(batch.schema.get_field_index("vector")), dims)
            a, b = nearest(x[:, :cut], first), nearest(x[:, cut:], second)
            da, db = x[:, :cut] - first[a], x[:, cut:] - second[b]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                 pa.array((da * da).sum(axis=1)), pa.array((db * db).sum(axis=1))],
                names=[*batch.schema.names, "c1", "c2", "d1", "d2"])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    indexed = stored(rows.mapInArrow(place, f"{kinds}, c1 int, c2 int, d1 long, d2 long"), "negatives-indexed")
    cells = indexed.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"),
                                            F.max("d2").alias("d2")).collect()   # at most MAX_CODES ** 2
    far = (np.zeros(len(first), np.int64), np.zeros(len(second), np.int64))
    for r in cells:
        far[0][r["c1"]] = max(far[0][r["c1"]], r["d1"])
        far[1][r["c2"]] = max(far[1][r["c2"]], r["d2"])
    return indexed, Index(first, second, (V.up_root(far[0]), V.up_root(far[1])),
                          {(r["c1"], r["c2"]): (r["n"], int(V.up_root(r["d1"])), int(V.up_root(r["d2"])))
                           for r in cells}, dims)


def block_table(indexed: DataFrame, index: Index) -> DataFrame:
    """(c1, c2, block, uids, ids, labels, vectors): a cell's rows in blocks, by id."""
    spark, dims = indexed.sparkSession, index.dims
    # one row per cell
    sizes = spark.createDataFrame([(*c, -(-n // BLOCK_ROWS)) for c, (n, _, _) in index.cells.items()], "k1 int, k2 int, blocks int")
    cut = indexed.join(F.broadcast(sizes), (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2"))).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))

    def pack(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        batch = batch.sort_by([("id", "ascending"), ("uid", "ascending")]).combine_chunks()
        x = V.matrix(batch.column("vector").combine_chunks(), dims)
        blob = lambda c: pa.array([batch.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary())
        return pa.Table.from_arrays(
            [pa.array([k.as_py()], pa.int32()) for k in key] + [blob("uid"), blob("id"), blob("label"),
             pa.array([x.astype(np.int32).tobytes()], pa.binary())],
            names=["c1", "c2", "block", "uids", "ids", "labels", "vectors"])

    cols = ["uid", "id", "label", "vector", "c1", "c2", "block"]
    packed = cut.select(*cols).groupBy("c1", "c2", "block").applyInArrow(
        pack, "c1 int, c2 int, block int, uids binary, ids binary, labels binary, vectors binary")
    return stored(packed, "negatives-blocks")


def visits(anchors: DataFrame, index: Index, first: bool) -> DataFrame:
    """(c1, c2, block, uid, label, vector, wants) of the blocks an anchor looks at.

    ``wants`` are the scores a listed row must not pass (positives: one without
    limit), ``needs`` the score a further row must reach. The first walk ends
    after FIRST_ROWS rows, the second starts there; both end under ``needs``.
    """
    spark = anchors.sparkSession
    dims = index.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = V.matrix(batch.column("vector"), dims)
            needs = batch.column("needs").to_pylist()
            for k in range(batch.num_rows):
                seen, c1, c2, block, most = 0, [], [], [], index.cell_bound(x[k])
                for bound, a, b in index.walk(x[k]):
                    early = seen < FIRST_ROWS
                    if bound < needs[k] or (first and not early):
                        break
                    rows = index.cells[a, b][0]
                    seen += rows
                    # a cell may be out by its own radii before the walk ends
                    if early == first and most(a, b) >= needs[k]:
                        n = -(-rows // BLOCK_ROWS)
                        c1 += [a] * n
                        c2 += [b] * n
                        block += range(n)
                if block:
                    same = pa.array(np.full(len(block), k))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c1, pa.int32()), pa.array(c2, pa.int32()), pa.array(block, pa.int32()),
                         *[batch.column(c).take(same) for c in ("uid", "label", "vector", "wants")]],
                        names=["c1", "c2", "block", "uid", "label", "vector", "wants"])

    prepare(spark)
    return anchors.select("uid", "label", "vector", "wants", "needs").mapInArrow(
        run, "c1 int, c2 int, block int, uid long, label long, vector array<int>, wants array<long>")


def best_columns(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``most`` highest allowed scores per row; ties: lower column."""
    n = scores.shape[1]
    masked = np.where(allowed, scores, NONE)
    if n > most:
        top = np.argsort(~masked, axis=1, kind="stable")[:, :most]
    else:
        top = np.broadcast_to(np.arange(n), masked.shape)
    row = np.repeat(np.arange(len(scores)), top.shape[1])
    col = top.reshape(-1)
    good = allowed[row, col]
    return row[good], col[good]


def meet(requests: DataFrame, blocks: DataFrame, batches: int, dims: int, most: int, same_label: bool,
         window: tuple[int, int]) -> DataFrame:
    """(uid, want, score, id): of every block met, the ``most`` best rows per anchor and want."""
    packed = requests.groupBy("c1", "c2", "block", F.pmod(F.xxhash64("uid"), F.lit(batches)).alias("batch")).agg(
        F.collect_list(F.struct("uid", "label", "vector", "wants")).alias("anchors"))
    both = packed.join(blocks, ["c1", "c2", "block"]).select("anchors", "uids", "ids", "labels", "vectors")
    low, high = window

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in data:
            for k in range(batch.num_rows):
                asks = batch.column("anchors").slice(k, 1).flatten()
                uid, label, vector, wants = [asks.field(i) for i in range(4)]
                q = V.matrix(vector, dims)
                ids, uids, labels = [np.frombuffer(batch.column(c)[k].as_py(), np.int64) for c in ("ids", "uids", "labels")]
                x = np.frombuffer(batch.column("vectors")[k].as_py(), np.int32).reshape(len(ids), dims).astype(np.int64)
                scores = V.products(q, x)
                own, mine = uid.to_numpy(), label.to_numpy()
                kind = (mine[:, None] == labels[None, :]) == same_label
                kind &= own[:, None] != uids[None, :]
                lengths = np.diff(wants.offsets.to_numpy())[:len(own)]
                flat, at = wants.flatten().to_numpy(), np.cumsum(lengths) - lengths
                for w in range(lengths.max(initial=0)):
                    who = np.flatnonzero(lengths > w)
                    want = flat[at[who] + w]
                    s, ok = scores[who], kind[who]
                    if not same_label:
                        t = want[:, None]
                        ok &= (100 * s <= high * t) & (100 * s >= low * t)
                    row, col = best_columns(s, ok, most)
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own[who][row]), pa.array(want[row]), pa.array(s[row, col]), pa.array(ids[col])],
                            names=["uid", "want", "score", "id"])

    found = both.mapInArrow(run, "uid long, want long, score long, id long")
    return found


def cut_lists(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best of every list, ranked; the limit works before the shuffle, too."""
    w = Window.partitionBy("uid", "want").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def search(anchors: DataFrame, index: Index, blocks: DataFrame, batches: int, most: int, same_label: bool,
           window: tuple[int, int], name: str) -> DataFrame:
    """(uid, want, score, id, rank): both walks of every anchor."""
    low = window[0]
    ask = lambda a, first: cut_lists(meet(visits(a, index, first), blocks, batches, index.dims, most,
                                          same_label, window), most)
    early = stored(ask(anchors, True), f"{name}-early")
    # what a further row must reach: the last of a full list, else the window's lower end
    full = early.where(F.col("rank") == most).select(F.col("uid").alias("u"), F.col("want").alias("w"),
                                                     F.col("score").alias("last"))
    floor = F.lit(NONE) if same_label else F.ceil(F.col("want") * low / 100).cast("long") - 1
    lists = anchors.select("uid", F.explode("wants").alias("want")).join(
        full, (F.col("uid") == F.col("u")) & (F.col("want") == F.col("w")), "left")
    need = lists.groupBy(F.col("uid").alias("u")).agg(
        F.min(F.greatest(floor, F.coalesce("last", F.lit(NONE)))).alias("need"))
    later = anchors.join(need, F.col("uid") == F.col("u")).withColumn("needs", F.col("need")).drop("u", "need")
    return stored(cut_lists(early.drop("rank").unionByName(ask(later, False).drop("rank")), most), name)


def hard_negatives(df: DataFrame, anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = (LOW, HIGH), scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which rows are anchors, by the columns of ``df``."""
    spark = df.sparkSession
    prepare(spark)
    given = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                      F.col(f"`{vector_col}`").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & V.finite(F.col("v")))
    named = given.select("id", "label", "anchor", V.integers(F.col("v"), scale).alias("vector"),
                         F.monotonically_increasing_id().alias("uid"))
    # a row is its uid from here on
    rows = stored(named, "negatives-rows")
    about = rows.agg(F.max(F.size("vector")).alias("dims"), F.count(F.lit(1)).alias("n"),
                     F.sum(F.col("anchor").cast("long")).alias("anchors")).first()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    if not about["anchors"]:
        return empty
    dims = max(about["dims"], 2)
    indexed, index = build_index(rows, dims, about["n"])
    blocks = block_table(indexed, index)
    batches = -(-about["anchors"] // BATCH_ANCHORS)
    asked = rows.where("anchor").select("uid", F.col("id").alias("anchor_id"), "label", "vector")
    near = search(asked.withColumns({"wants": F.array(F.lit(0).cast("long")), "needs": F.lit(NONE)}), index, blocks,
                  batches, positives, True, window, "negatives-positives")
    goals = near.groupBy(F.col("uid").alias("u")).agg(F.sort_array(F.collect_set("score")).alias("wants"))
    low = window[0]
    # under every window nothing is asked for; the smallest positive score has the lowest
    goals = goals.withColumn("needs", F.ceil(F.array_min("wants") * low / 100).cast("long") - 1)
    asked_too = stored(asked.join(goals, F.col("uid") == F.col("u")).drop("u"), "negatives-asked")
    hard = search(asked_too, index, blocks, batches, negatives, False, window, "negatives-found")
    pairs = near.select(F.col("uid").alias("u"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    out = hard.join(pairs, (F.col("uid") == F.col("u")) & (F.col("want") == F.col("positive_score")))
    names = asked.select(F.col("uid").alias("a"), "anchor_id")
    return out.join(names, F.col("uid") == F.col("a")).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: ids divisible by 100. Where the id is divisible by 7, the label is a
    wrong one, the next of ten."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


__all__ = ["Index", "hard_negatives", "query"]
