"""Centroid clustering by a tournament of bisectors (operator 11).

Vectors become integers, so every step is exact. For two centroids a < b the integer normal
``2 (b - a)`` and the threshold ``|b|^2 - |a|^2`` tell on which side of their bisecting plane a vector
lies: a vector x is nearer to b if ``normal . x - threshold > 0``; zero goes to a, the smaller number. Each vector
keeps a champion, at first centroid 0, and meets the other k - 1 centroids once each in
ascending order; a lost test eliminates the loser. Only the distance to the last champion is computed.

A round is one Spark job: tasks send one row per (cluster, component) of their own sums, Spark adds them up, and
the driver sees k * dim sums. Only the k centroids are shipped to tasks; each makes the table of pairs
(k^2 * dim numbers, bounded by ``MOST_PAIR_NUMBERS``) for itself.

Defined results: vectors that are null, of another length, or hold a null or non-finite component are left out, and
so are those with a component of 2^27 or more after scaling, whose squared distances need not fit 64 bits; fewer
vectors than k give as many centroids; rows that share an id are vectors of their own (equal hashes are ordered by
the vectors); a null id counts as the empty text in the hash; a cluster without vectors keeps its centroid; no
vectors give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.session import scratch_path

#: Components are below this in size, so that distances and tests of 64 components fit a signed 64-bit number.
LIMIT = 1 << 27
#: Numbers of the table of pairs that a task may hold (128 MB).
MOST_PAIR_NUMBERS = 1 << 24


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, scale: int = 256) -> DataFrame:
    """id, x: floor(scale * component) of the vectors that are kept."""
    def run(batches):
        for b in batches:
            v = b.column("v")
            right = pc.fill_null(pc.equal(pc.list_value_length(v), dim), False)
            b = b.filter(right)
            if not b.num_rows:
                continue
            m = pc.fill_null(b.column("v").flatten(), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
            with np.errstate(invalid="ignore", over="ignore"):
                m = np.floor(scale * m)
                ok = (np.abs(m) < LIMIT).all(1)
            ids, m = b.column("id").filter(pa.array(ok)), m[ok].astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, _lists(m)], names=["id", "x"])

    v = F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).mapInArrow(run, "id long, x array<int>")


def _lists(m: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(m.reshape(-1)))


class Tournament:
    """Normals and thresholds of all pairs of centroids; ``nearest`` runs the k - 1 tests."""

    def __init__(self, centroids: np.ndarray):
        c = centroids.astype(np.int64)
        if len(c) * len(c) * c.shape[1] > MOST_PAIR_NUMBERS:
            raise ValueError("too many centroids for a table of their pairs")
        self.centroids = c
        self.normals = 2 * (c[None, :, :] - c[:, None, :])          # [a, b]: 2 (b - a)
        size = (c * c).sum(1)
        self.thresholds = size[None, :] - size[:, None]
        self.widest = int(np.abs(self.normals).max(initial=0)) * c.shape[1]
        # sums below 2^53 are exact in doubles as well, and a product of doubles is quicker
        self.doubles = self.normals.astype(np.float64)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of each row's nearest centroid; ties go to the smaller number."""
        champion = np.zeros(len(x), np.int64)
        short = int(np.abs(x).max(initial=0)) * self.widest < 1 << 52
        x, normals = (x.astype(np.float64), self.doubles) if short else (x.astype(np.int64), self.normals)
        for b in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", x, normals[champion, b]) - self.thresholds[champion, b]
            champion[side > 0] = b
        return champion

    def distance(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        d = x.astype(np.int64) - self.centroids[cluster]
        return (d * d).sum(1)


ROWS = 4096


def _assigned(batches, t: Tournament):
    """(ids, matrix, cluster) of runs of at most ``ROWS`` vectors."""
    dim = t.centroids.shape[1]
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield part.column("id"), x, t.nearest(x)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:id``, in that order; equal hashes by the vectors."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in rows], np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid that has vectors becomes their exact floored mean."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    k, dim = centroids.shape

    def run(batches):
        t = Tournament(shared.value)
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x, cluster in _assigned(batches, t):
            order = np.argsort(cluster, kind="stable")
            own, first = np.unique(cluster[order], return_index=True)
            total[own] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
            count += np.bincount(cluster, minlength=k)
        own = np.flatnonzero(count)
        if len(own):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(own, dim).astype(np.int32)), pa.array(np.tile(np.arange(dim, dtype=np.int32), len(own))),
                 pa.array(total[own].reshape(-1)), pa.array(np.repeat(count[own], dim))], names=["cluster", "dim", "s", "n"])

    sums = (vectors.mapInArrow(run, "cluster int, dim int, s long, n long")
            .groupBy("cluster", "dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")))
    new = centroids.copy()
    for r in sums.collect():                                         # at most k * dim rows
        new[r["cluster"], r["dim"]] = int(r["s"]) // int(r["n"])
    shared.unpersist()
    return new


def cluster(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster, distance of every vector, to given centroids."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        t = Tournament(shared.value)
        for ids, x, own in _assigned(batches, t):
            yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(t.distance(x, own))],
                                             names=["id", "cluster", "distance"])

    return vectors.mapInArrow(run, "id long, cluster int, distance long")


def centroid_clusters(df: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, id_col: str = "vec_id",
                      vec_col: str = "embedding", dim: int = 64, scale: int = 256) -> DataFrame:
    """id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = df.sparkSession
    base = scratch_path(spark, "clusters")
    integer_vectors(df, id_col, vec_col, dim, scale).write.parquet(f"{base}/vectors")
    vectors = spark.read.parquet(f"{base}/vectors")
    out = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"`{id_col}` long, {out}")
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    cluster(vectors, centroids).write.parquet(f"{base}/assigned")
    assigned = spark.read.parquet(f"{base}/assigned")
    per = {r["cluster"]: int(r["s"]) for r in                         # at most k rows
           assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(c, s, sum(per.values()), digest[c]) for c, s in per.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(facts), "cluster")              # k rows
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
