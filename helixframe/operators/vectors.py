"""Embedding, similarity and nearest-neighbour operators.

Vectors are ``array<float>`` (or double) columns, one per row. Exact k-NN is a block join: stored rows and
queries are dealt into blocks, shuffled by pair of blocks, and a kernel keeps each query's k best of a pair, so
query x stored pairs never become rows and neither side is collected. A final ``row_number() <= k`` (partial before its
exchange) merges the pairs' candidates. Similarities and distances of all rows are tiles of the same kind.
"""

from __future__ import annotations

import hashlib
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from helixframe.functions import text as T
from helixframe.functions import vectors as VF
from helixframe.session import scratch_path

MAX_CENTROIDS = 5_000       # labels of the related/control comparison (one ordering window)


# ------------------------------------------------------------- V1

def embed_hashed(df: DataFrame, text_col: str, key: str, dim: int = VF.HASH_DIM,
                 out: str = "embedding") -> DataFrame:
    """V1 default encoder: L2-normalised bag of hashed word tokens, array<double>(dim).

    A function of the row alone (no shuffle, rows that share ``key`` keep their own vectors): tokens are
    split in the JVM, an Arrow UDF buckets each batch's distinct tokens by md5 and counts them with numpy.
    A text with no token gets NULL; the text column is dropped.
    """
    return df.withColumn(out, _hash_encoder(dim)(T.word_tokens_nolambda(F.col(text_col)))).drop(text_col)


def _hash_encoder(dim: int):
    @F.arrow_udf("array<double>")
    def enc(tokens: pa.Array) -> pa.Array:
        n = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(tokens.flatten())
        bucket = np.array([int(hashlib.md5(t.encode()).hexdigest()[:4], 16) % dim for t in coded.dictionary.to_pylist()], np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        cells = bucket[coded.indices.to_numpy(zero_copy_only=False)] if len(owner) else np.empty(0, np.int64)
        m = np.bincount(owner * dim + cells, minlength=len(n) * dim).reshape(len(n), dim).astype(np.float64)
        m /= np.maximum(np.sqrt((m * m).sum(axis=1, keepdims=True)), 1.0)
        ends = pa.array(np.arange(len(n) + 1) * dim, pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(m.reshape(-1)), mask=pa.array(n == 0))
    return enc


def embed_with(df: DataFrame, text_col: str, encoder: Callable[[list[str]], np.ndarray],
               out: str = "embedding", batch_size: int = 32) -> DataFrame:
    """V1 plug-in: any ``list[str] -> ndarray(n, d)`` encoder as an iterator pandas UDF.

    The encoder object is built once per Python worker (iterator UDF), fed
    ``batch_size`` texts per call, and rows are L2-normalised float32.
    """
    @F.pandas_udf("array<float>")
    def enc(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            texts = s.fillna("").tolist()
            parts = [np.asarray(encoder(texts[i:i + batch_size]), dtype=np.float32)
                     for i in range(0, len(texts), batch_size)]
            m = np.concatenate(parts) if parts else np.zeros((0, 0), np.float32)
            n = np.linalg.norm(m, axis=1, keepdims=True)
            m = np.where(n > 0, m / np.where(n > 0, n, 1), m)
            yield pd.Series(list(m))
    return df.withColumn(out, enc(F.col(text_col)))


# ------------------------------------------------------------- V3 / V4 / V5

def centroids(df: DataFrame, group: str = "gene", vec: str = "embedding") -> DataFrame:
    """V4 + A11: per-group mean vector, re-normalised: (group, centroid array<double>).

    Long form (group, dim) averages, so a group holding most rows is
    combined map-side before its single shuffle.
    """
    long = df.select(group, F.posexplode(VF.as_double(vec)).alias("dim", "x"))
    m = long.groupBy(group, "dim").agg(F.avg("x").alias("x"))
    arr = m.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("__p"))
    return arr.select(group, VF.l2_normalize(F.transform("__p", lambda s: s["x"])).alias("centroid"))


TILE = 512      # rows of one side of a tile


def tiled_pairs(rows: DataFrame, tile: Callable[[pd.DataFrame, pd.DataFrame], tuple[np.ndarray, np.ndarray]], value: str, size: int | None = None) -> DataFrame:
    """All pairs of rows (key ``k`` and any columns) in long form (a, b, value), by tiles of a row-block grid.

    Rows are dealt into blocks of about ``size``; only tiles of the upper triangle are computed, each from two blocks, and
    mirrored on output. ``tile`` gives (values, which pairs to report). The output is n^2 rows by definition; nothing is
    collected, and a row is shuffled once per block.
    """
    blocks = max(1, -(-rows.count() // (size or TILE)))
    dealt = rows.withColumn("__own", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int"))
    grid = (dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .withColumn("__i", F.least("__own", "__other")).withColumn("__j", F.greatest("__own", "__other")))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = key
        left, right = pdf[pdf["__own"] == i], pdf[pdf["__own"] == j]
        if left.empty or right.empty:
            return pd.DataFrame()
        got, keep = tile(left, right)
        r, c = np.nonzero(keep)
        if not len(r):
            return pd.DataFrame()
        a, b, v = left["k"].to_numpy()[r], right["k"].to_numpy()[c], got[r, c]
        if i != j:
            a, b, v = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([v, v])
        return pd.DataFrame({"a": a, "b": b, value: v})

    return grid.groupBy("__i", "__j").applyInPandas(run, f"a string, b string, {value} double")


def similarity_matrix(c: DataFrame, key: str = "gene", vec: str = "centroid") -> DataFrame:
    """V5 + J9: similarities (dot products) of all rows with a vector, long form (a, b, sim)."""
    def tile(left, right):
        sim = np.stack(left["v"].to_numpy()).astype(np.float64) @ np.stack(right["v"].to_numpy()).astype(np.float64).T
        return sim, np.ones(sim.shape, bool)

    rows = c.select(F.col(key).cast("string").alias("k"), VF.as_double(vec).alias("v")).where("v IS NOT NULL")
    return tiled_pairs(rows, tile, "sim")


def cosine_pairs(pairs: DataFrame, a: str, b: str) -> Column:
    """V3: cosine of unit vectors = their dot product."""
    return VF.dot(a, b)


# ------------------------------------------------------------- V6 / J7 / W7

ROW_BLOCK = 4_096                              # stored rows scored at a time
STORED_BLOCK, QUERY_BLOCK = 32_768, 2_048      # rows and queries of one unit of work


def _topk_kernel(qids: np.ndarray, qmat: np.ndarray, k: int, id_col: str, vec_col: str, extra: list[str]):
    qn = (qmat * qmat).sum(axis=1)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the k best so far of each query, ties in distance by id; emitted once, at the task's end
        best = None
        limit = np.full(len(qids), np.inf)
        for pdf in it:
            pdf = pdf[pdf[vec_col].notna()].reset_index(drop=True)
            for lo in range(0, len(pdf), ROW_BLOCK):
                part = pdf.iloc[lo:lo + ROW_BLOCK].reset_index(drop=True)
                x = np.stack(part[vec_col].to_numpy()).astype(np.float64)
                if x.shape[1] != qmat.shape[1]:
                    raise ValueError(f"vector length {x.shape[1]} != query length {qmat.shape[1]}")
                xn, found = (x * x).sum(axis=1)[:, None], []
                for q in range(0, len(qids), QUERY_BLOCK):
                    d = np.maximum(xn + qn[None, q:q + QUERY_BLOCK] - 2.0 * (x @ qmat[q:q + QUERY_BLOCK].T), 0.0)
                    r = np.round(d, 9)
                    kk = min(k, len(d))
                    bar = np.minimum(np.partition(r, kk - 1, axis=0)[kk - 1], limit[q:q + QUERY_BLOCK])
                    rows, cols = np.nonzero(r <= bar[None, :])
                    if len(rows):
                        new = part.loc[rows, [id_col, *extra]].reset_index(drop=True).rename(columns={id_col: "id"})
                        new["__q"], new["distance"], new["__r"] = cols + q, d[rows, cols], r[rows, cols]
                        found.append(new)
                if found:
                    best = pd.concat(found if best is None else [best, *found], ignore_index=True)
                    best = best.sort_values(["__q", "__r", "id"], kind="stable").groupby("__q", sort=False).head(k).reset_index(drop=True)
                    full = best.groupby("__q")["__r"].agg(["size", "max"])
                    full = full[full["size"] >= k]
                    limit[full.index.to_numpy()] = full["max"].to_numpy()
        if best is not None:
            best["query_id"] = qids[best["__q"].to_numpy()]
            yield best[["query_id", "id", "distance", *extra]]
    return run


def _sides(stored: DataFrame, queries: DataFrame, id_col: str, vec_col: str, query_id: str, query_vec: str, extra: list[str]):
    """(id, vector, extras) of the stored rows and (query, vector) of the queries, rows without a vector too."""
    s = stored.select(F.col(id_col).cast("string").alias("__id"), VF.as_double(vec_col).alias("__v"), *extra)
    q = queries.select(F.col(query_id).cast("string").alias("__q"), VF.as_double(query_vec).alias("__qv"))
    return s, q


def _score_units(s: DataFrame, q: DataFrame, unit: list[str], k: int, extra: list[str]) -> DataFrame:
    """query_id, id, distance, extras: each query's k best of every unit that both sides have rows of."""
    schema = Ty.StructType([Ty.StructField("query_id", Ty.StringType()), Ty.StructField("id", Ty.StringType()),
                            Ty.StructField("distance", Ty.DoubleType())] + [s.schema[e] for e in extra])

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(rows) and len(asked):
            # a unit may have more queries than a block: the kernel takes these in turn
            kernel = _topk_kernel(asked["__q"].to_numpy(), np.stack(asked["__qv"].to_numpy()), k, "__id", "__v", extra)
            got = list(kernel(iter([rows])))
        return got[0] if got else pd.DataFrame()

    return s.groupBy(*unit).cogroup(q.groupBy(*unit)).applyInPandas(run, schema)


def _ranked(cand: DataFrame, k: int, extra: list[str]) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 9), F.col("id"))
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance", *extra)


def knn_exact(stored: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "embedding",
              query_id: str = "query_id", query_vec: str = "embedding", extra: list[str] | None = None) -> DataFrame:
    """V6: exact k nearest stored rows per query by squared L2 distance, for any number of queries.

    (query_id, rank, id, distance, extra...), rank 1-based, ties by id; fewer than k rows when the collection is
    smaller. A block join in one plan: every block of stored rows meets every block of queries once. Rows are dealt by their
    number, so repeated ids or vectors fill no block.
    """
    extra = extra or []
    s, q = _sides(stored, queries, id_col, vec_col, query_id, query_vec, extra)
    spark = stored.sparkSession
    # counted before the vectors are made: rows without one only make blocks smaller
    n_rows, n_queries = stored.count(), queries.count()
    blocks = max(1, -(-n_rows // STORED_BLOCK), min(spark.sparkContext.defaultParallelism, n_rows // ROW_BLOCK))
    asked = max(1, -(-n_queries // QUERY_BLOCK))
    number = F.monotonically_increasing_id()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # the rows' number stands between the encoder and the test for a vector: before it, the test would encode each text again
    s = s.withColumn("__r", F.pmod(number, F.lit(blocks)).cast("int")).where("__v IS NOT NULL").withColumn("__b", every(asked))
    q = q.withColumn("__b", F.pmod(number, F.lit(asked)).cast("int")).where("__qv IS NOT NULL").withColumn("__r", every(blocks))
    return _ranked(_score_units(s, q, ["__r", "__b"], k, extra), k, extra)


# ------------------------------------------------------------- V7

MAX_CELLS = 4_096        # centres shipped to tasks; with their radii, the only facts the driver holds


def _cell_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2.0 * (x @ centers.T)
    return np.sqrt(np.maximum(d, 0.0))


class InvertedFile:
    """V7: stored rows in cells of a distributed k-means, searched exactly from few cells.

    Built once: Lloyd rounds over the rows (tasks send sums per cell, Spark adds them up), every row written with its cell and its
    distance to the centre, and per cell its radius and size (at most ``MAX_CELLS`` facts on the driver).
    """

    def __init__(self, stored: DataFrame, cells: int | None = None, id_col: str = "id", vec_col: str = "embedding",
                 extra: list[str] | None = None, seed: int = 7, iterations: int = 5):
        spark, self.extra = stored.sparkSession, extra or []
        s = stored.select(F.col(id_col).cast("string").alias("__id"), VF.as_double(vec_col).alias("__v"), *self.extra).where("__v IS NOT NULL")
        path = scratch_path(spark, "inverted-file")
        s.write.parquet(f"{path}/rows")
        s = spark.read.parquet(f"{path}/rows")
        self.n = s.count()
        k = max(1, min(MAX_CELLS, cells or round(self.n ** 0.5)))
        # the first centres: the different vectors among the k rows with the smallest hash
        picked = s.orderBy(F.xxhash64("__id", "__v", F.lit(seed))).limit(k).select("__v").collect()
        self.centers = np.unique(np.array([r["__v"] for r in picked], np.float64), axis=0) if picked else np.zeros((1, 0))
        for _ in range(iterations if len(self.centers) > 1 else 0):
            self._move(s)
        shared = spark.sparkContext.broadcast(self.centers)
        schema = Ty.StructType([*s.schema.fields, Ty.StructField("__cell", Ty.IntegerType()), Ty.StructField("__far", Ty.DoubleType())])

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    d = _cell_distances(np.stack(pdf["__v"].to_numpy()), shared.value)
                    own = d.argmin(1)
                    yield pdf.assign(__cell=own.astype(np.int32), __far=d[np.arange(len(own)), own])

        s.mapInPandas(place, schema).write.parquet(f"{path}/cells")
        self.rows = spark.read.parquet(f"{path}/cells")
        self.size, self.radius = np.zeros(len(self.centers), np.int64), np.zeros(len(self.centers))
        for r in self.rows.groupBy("__cell").agg(F.count("*").alias("n"), F.max("__far").alias("far")).collect():
            self.size[r["__cell"]], self.radius[r["__cell"]] = r["n"], r["far"]

    def _move(self, rows: DataFrame) -> None:
        """One round: every centre that has rows becomes their mean."""
        shared = rows.sparkSession.sparkContext.broadcast(self.centers)

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centers = shared.value
            total, count = np.zeros(centers.shape), np.zeros(len(centers), np.int64)
            for pdf in batches:
                if len(pdf):
                    x = np.stack(pdf["__v"].to_numpy())
                    own = _cell_distances(x, centers).argmin(1)
                    np.add.at(total, own, x)
                    count += np.bincount(own, minlength=len(centers))
            c = np.flatnonzero(count)
            if len(c):                                      # a task without rows has no sums (and Arrow no type for them)
                yield pd.DataFrame({"cell": c.astype(np.int32), "n": count[c], "s": list(total[c])})

        per = (rows.select("__v").mapInPandas(sums, "cell int, n long, s array<double>")
               .select("cell", "n", F.posexplode("s").alias("dim", "x")).groupBy("cell", "dim").agg(F.sum("n").alias("n"), F.sum("x").alias("x")))
        moved = self.centers.copy()
        for r in per.collect():                             # cells x dimensions
            moved[r["cell"], r["dim"]] = r["x"] / r["n"]
        self.centers = moved

    def _route(self, queries: DataFrame, least: int, bounded: bool) -> DataFrame:
        """(query, vector, cell) of the nearest cells that hold ``least`` rows together; with ``bounded`` instead the other cells
        that may hold a row within the query's distance ``__t`` so far (triangle inequality: centre distance less radius)."""
        shared = self.rows.sparkSession.sparkContext.broadcast((self.centers, self.size, self.radius))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centers, size, radius = shared.value
            for pdf in batches:
                if not len(pdf) or not size.any():
                    continue
                d = _cell_distances(np.stack(pdf["__qv"].to_numpy()), centers)
                order = np.argsort(d, axis=1, kind="stable")
                held = np.cumsum(size[order], axis=1)
                first = np.zeros(d.shape, bool)
                np.put_along_axis(first, order, (held - size[order] < least) & (size[order] > 0), axis=1)
                take = first
                if bounded:
                    reach = np.sqrt(np.nan_to_num(pdf["__t"].to_numpy(np.float64), nan=np.inf, posinf=np.inf)) + 1e-7
                    take = ~first & (size > 0)[None, :] & (d - radius[None, :] <= reach[:, None])
                row, cell = np.nonzero(take)
                if len(row):
                    yield pd.DataFrame({"__q": pdf["__q"].to_numpy()[row], "__qv": pdf["__qv"].to_numpy()[row], "__cell": cell.astype(np.int32)})

        return queries.mapInPandas(run, "__q string, __qv array<double>, __cell int")

    def _search(self, routed: DataFrame, k: int) -> tuple[DataFrame, int]:
        """Each query's k best of its cells, and the number of pairs scored. Big cells and many queries are split."""
        spark = self.rows.sparkSession
        path = scratch_path(spark, "routed")
        routed.write.parquet(path)
        routed = spark.read.parquet(path)
        asked = {r["__cell"]: r["n"] for r in routed.groupBy("__cell").agg(F.count("*").alias("n")).collect()}      # one number a cell
        plan = spark.createDataFrame([(c, int(-(-int(self.size[c]) // STORED_BLOCK)), int(-(-n // QUERY_BLOCK))) for c, n in asked.items()],
                                     "__cell int, __subs int, __asks int")
        number, every = F.monotonically_increasing_id(), lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        s = (self.rows.join(F.broadcast(plan), "__cell").withColumn("__r", F.pmod(number, F.col("__subs")).cast("int"))     # at most MAX_CELLS rows
             .withColumn("__b", every("__asks")).drop("__subs", "__asks"))
        q = (routed.join(F.broadcast(plan), "__cell").withColumn("__b", F.pmod(number, F.col("__asks")).cast("int"))
             .withColumn("__r", every("__subs")).drop("__subs", "__asks"))
        return _score_units(s, q, ["__cell", "__r", "__b"], k, self.extra), sum(int(self.size[c]) * n for c, n in asked.items())

    def search(self, queries: DataFrame, k: int = 5, query_id: str = "query_id", query_vec: str = "embedding") -> tuple[DataFrame, dict]:
        """The k nearest rows of every query as :func:`knn_exact` ranks them (all k whenever so many rows exist), and
        {pairs, all_pairs}: distances computed here and by the block join.

        First the nearest cells that hold k rows or more; the k-th distance then bounds which other cells can hold a nearer row,
        and these are searched in a second pass.
        """
        spark = self.rows.sparkSession
        q = queries.select(F.col(query_id).cast("string").alias("__q"), VF.as_double(query_vec).alias("__qv")).where("__qv IS NOT NULL")
        path = scratch_path(spark, "first-cells")
        near, pairs = self._search(self._route(q, k, False), k)
        near.write.parquet(path)
        near = spark.read.parquet(path)
        worst = _ranked(near, k, []).where(F.col("rank") == k).select(F.col("query_id").alias("__q"), F.col("distance").alias("__t"))
        far, more = self._search(self._route(q.join(worst, "__q", "left"), k, True), k)
        return _ranked(near.unionByName(far), k, self.extra), {"pairs": pairs + more, "all_pairs": self.n * q.count()}


def knn_ivf(stored: DataFrame, queries: DataFrame, k: int = 5, cells: int | None = None, **kw) -> DataFrame:
    """V7 in one call: :class:`InvertedFile` over ``stored``, searched for ``queries``."""
    return InvertedFile(stored, cells, **kw).search(queries, k)[0]


def knn_lsh(stored: DataFrame, queries: DataFrame, k: int = 5, threshold: float = 1.0,
               bucket_length: float = 0.5, num_tables: int = 8, id_col: str = "id", vec_col: str = "embedding",
               query_id: str = "query_id", seed: int = 7) -> DataFrame:
    """Random-projection LSH, exact re-rank of the candidates (may find fewer than k; :func:`knn_ivf` does not).

    Candidates are pairs sharing an LSH bucket within ``threshold`` (L2);
    only those are scored, then the same rank rule as V6 applies.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    s = stored.select(F.col(id_col).cast("string").alias("id"), array_to_vector(VF.as_double(vec_col)).alias("features"))
    q = queries.select(F.col(query_id).cast("string").alias("query_id"),
                       array_to_vector(VF.as_double("embedding")).alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                        numHashTables=num_tables, seed=seed).fit(s)
    pairs = model.approxSimilarityJoin(q, s, threshold, distCol="l2")
    out = pairs.select(F.col("datasetA.query_id").alias("query_id"), F.col("datasetB.id").alias("id"),
                       (F.col("l2") * F.col("l2")).alias("distance"))
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 9), "id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall_at_k(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """Share of exact top-k ids the approximate search also returns, per query."""
    hit = exact.join(approx.select("query_id", "id", F.lit(1).alias("h")), ["query_id", "id"], "left")
    return hit.groupBy("query_id").agg((F.count("h") / F.count(F.lit(1))).alias("recall"))


# ------------------------------------------------------------- J8 / V8 / P21

def rank_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side-by-side result lists on (query_id, rank), cut to the shorter one."""
    sa = a.select("query_id", "rank", *[F.col(c).alias(f"{c}_a") for c in a.columns if c not in ("query_id", "rank")])
    sb = b.select("query_id", "rank", *[F.col(c).alias(f"{c}_b") for c in b.columns if c not in ("query_id", "rank")])
    return sa.join(sb, ["query_id", "rank"], "inner")


def ablation_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """V8: per query, ids shared by both top-k lists and the largest distance shift
    of a shared id."""
    j = a.select("query_id", "id", F.col("distance").alias("da")).join(
        b.select("query_id", "id", F.col("distance").alias("db")), ["query_id", "id"], "full_outer")
    return j.groupBy("query_id").agg(
        F.count_if(F.col("da").isNotNull() & F.col("db").isNotNull()).alias("overlap"),
        F.max(F.abs(F.col("da") - F.col("db"))).alias("max_shift"))


def hit_labels(side: DataFrame, suffix: str = "") -> Column:
    """P21 on one side of a rank join."""
    return T.hit_label(f"id{suffix}", f"gene{suffix}", f"distance{suffix}")


# ------------------------------------------------------------- J6

def ingest_rows(records: DataFrame, vectors: DataFrame, genes: DataFrame | None = None,
                text_builder: Callable[[], Column] = T.text_base, key: str = "pmid") -> DataFrame:
    """J6 + X1: collection rows (id, document, embedding, metadata{year, journal, gene}).

    Keyed joins replace the position zip; a record without a vector (or a
    vector without a record) raises instead of being cut silently.
    """
    v = vectors.select(F.col(key).alias("__k"), "embedding")
    rk = records.select(F.col(key).alias("__r"))
    both = rk.join(v, F.col("__r") == F.col("__k"), "full_outer")
    # checked while the rows are made, in the same join: no extra pass over either side
    bad = F.col("__r").isNull() | F.col("__k").isNull()
    vec = F.when(bad, F.raise_error(F.lit("records and vectors do not cover the same keys")).cast(v.schema["embedding"].dataType)).otherwise(F.col("embedding"))
    v = both.select(F.coalesce("__r", "__k").alias("__k"), vec.alias("embedding"))
    r = records.join(v, records[key] == v["__k"], "right")
    if genes is not None:
        r = r.join(genes.select(F.col(key).alias("__g"), F.col("genes").alias("__gene")), F.col(key) == F.col("__g"), "left")
    else:
        r = r.withColumn("__gene", F.lit(None).cast("string"))
    return r.select(F.col(key).alias("id"), text_builder().alias("document"), "embedding",
                    F.struct(F.col("year"), F.col("journal"), F.col("__gene").alias("gene")).alias("metadata"))
