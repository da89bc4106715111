"""Centroid clustering (13): bisector tournament.

A vector x is nearer to centroid i than to j where it lies on i's side of the
plane between them: ``2 x (c_j - c_i) <= |c_j|^2 - |c_i|^2``. Normals and
thresholds of all pairs are integers made once per round; every vector then
plays k - 1 sign tests, the winner so far against the next centroid, and a zero
goes to the smaller number. Distances are not computed until the last round, and
only to the winner.

The integer vectors are written once; a round is one pass over them in which
every task adds up its own vectors per cluster (at most k rows leave a task), so
a vector that a third of the rows share is nobody's group. What reaches the
driver is k times ``dims`` sums per round, whatever the table holds.

Defined results: a null vector, one of another length than ``dims``, and one with
a null or non-finite component take no part; a scaled component of 2**26 or more
fails the job (``vectors.LIMIT``); repeated rows and ids are vectors of their own;
a null id counts as an empty text in the hash; fewer vectors than ``k`` give as
many clusters; a cluster that loses all vectors keeps its centroid; an empty
table gives an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors as V
from .common import prepare, stored

DIMS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: vectors that meet the gathered normals at once
SLICE = 4_096


class Tournament:
    """Sign tests between all pairs of integer centroids."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        norms = (centroids * centroids).sum(axis=1)
        #: normals[i, j] x > thresholds[i, j] where x is nearer to j than to i
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = norms[None, :] - norms[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of every row; ties: the smaller."""
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            # the winner so far has a smaller number than j: on the plane it stays
            side = np.einsum("nd,nd->n", x, self.normals[best, j])
            best[side > self.thresholds[best, j]] = j
        return best

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        d = x - self.centroids[winner]
        return (d * d).sum(axis=1)


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of their ids, in hash order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    got = rows.select(order.alias("h"), "vector").orderBy("h", "vector").limit(k).collect()
    return np.array([r["vector"] for r in got], np.int64)


def _slices(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    at = batch.schema.get_field_index("vector")
    for lo in range(0, batch.num_rows, SLICE):
        yield lo, V.matrix(batch.column(at).slice(lo, SLICE), dims)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means of their vectors."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        play = Tournament(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, x in _slices(batch, dims):
                won = play.winners(x)
                order = np.argsort(won, kind="stable")
                own, start = np.unique(won[order], return_index=True)
                total[own] += np.add.reduceat(x[order], start)
                count += np.bincount(won, minlength=k)
        full = np.flatnonzero(count)
        if len(full):
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array(count[full]), pa.array(list(total[full]), pa.list_(pa.int64()))],
                names=["cluster", "members", "sums"])

    sums = rows.select("vector").mapInArrow(run, "cluster int, members long, sums array<long>")
    # one row per cluster and component; a sum over all tasks may pass 64 bits
    each = sums.select("cluster", "members", F.posexplode("sums").alias("place", "part"))
    per = each.groupBy("cluster", "place").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members"))
    out = centroids.copy()
    for r in per.collect():
        out[r["cluster"], r["place"]] = int(r["total"]) // r["members"]
    return out


def centroid_hash(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS,
                    k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(``id_col``, cluster, distance, cluster_inertia, inertia, centroid_sha256)
    of every vector that takes part."""
    spark = df.sparkSession
    prepare(spark)
    vector = F.col(f"`{vector_col}`")
    whole = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v")).where(
        V.finite(F.col("v")) & (F.size("v") == dims))
    rows = stored(whole.select("id", V.integers(F.col("v"), scale).alias("vector")), "cluster-vectors")
    centroids = first_centroids(rows, k, seed)
    id_type = dict(rows.dtypes)["id"]
    if not len(centroids):
        return spark.createDataFrame([], f"`{id_col}` {id_type}, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(rows, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        play = Tournament(centroids)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id"))
            for lo, x in _slices(batch, dims):
                won = play.winners(x)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, SLICE), pa.array(won, pa.int32()), pa.array(play.distances(x, won))],
                    names=["id", "cluster", "distance"])

    assigned = stored(rows.mapInArrow(assign, f"id {id_type}, cluster int, distance long"), "cluster-assigned")
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in per)
    # one row per cluster, at most k
    facts = spark.createDataFrame([(r["cluster"], int(r["s"]), total, centroid_hash(centroids[r["cluster"]]))
                                   for r in per], "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("c")).select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


__all__ = ["Tournament", "cluster_vectors", "query"]
