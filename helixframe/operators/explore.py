"""Exploration of transformed counts: D13 (PCA), D14 (row z-scores), D18 (distance matrices), J11."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.vectors import tiled_pairs


def rows_for(vst_long: DataFrame, genes: DataFrame, gene: str = "gene_id", by: str | None = None) -> DataFrame:
    """VST rows of a gene list; with ``by`` (a contrast) of every list at once, the column leading."""
    if by is None:
        return vst_long.join(genes.select(gene).distinct(), gene, "left_semi")
    return vst_long.join(genes.select(by, gene).distinct(), gene).select(by, *vst_long.columns)


def zscore_rows(long: DataFrame, gene: str | list[str] = "gene_id", value: str = "vst") -> DataFrame:
    """Per-gene z-score over samples with the population sd; sd 0 gives NULL. ``gene``: the row's key columns.

    One window partitioned by gene: each group is one gene's samples.
    """
    w = Window.partitionBy(gene)
    mu, sd = F.avg(value).over(w), F.stddev_pop(value).over(w)
    return long.withColumn("z", F.when(sd > 0, (F.col(value) - mu) / sd))


def distance_matrix(long: DataFrame, row: str, col: str, value: str = "z") -> DataFrame:
    """Euclidean distances between the ``row`` entities over the ``col`` they share (long form a, b, dist).

    Rows become vectors by one aggregate and meet in tiles (:func:`vectors.tiled_pairs`): a matrix product per tile,
    no join on the column key. Pairs that share no column are left out; null values count for nothing, and a pair
    without any other has a null distance.
    """
    def tile(left: pd.DataFrame, right: pd.DataFrame):
        cols = {c: n for n, c in enumerate(sorted({c for x in (*left["c"], *right["c"]) for c in x}))}

        def dense(frame):
            held, x = np.zeros((len(frame), len(cols))), np.full((len(frame), len(cols)), np.nan)
            for r, (names, values) in enumerate(zip(frame["c"], frame["v"], strict=True)):
                at = [cols[c] for c in names]
                held[r, at] = 1
                x[r, at] = np.array(values, np.float64)
            some = ~np.isnan(x)
            return held, some.astype(np.float64), np.where(some, x, 0.0)

        (ha, ma, xa), (hb, mb, xb) = dense(left), dense(right)
        squares = (xa * xa) @ mb.T + ma @ (xb * xb).T
        d2 = squares - 2.0 * (xa @ xb.T)
        # near-equal rows: the difference of large sums has no digits left, so these are summed directly
        for r, c in zip(*np.nonzero(d2 < 1e-6 * squares), strict=True):
            both = (ma[r] > 0) & (mb[c] > 0)
            d2[r, c] = ((xa[r] - xb[c])[both] ** 2).sum()
        return np.where(ma @ mb.T > 0, np.sqrt(np.maximum(d2, 0.0)), np.nan), ha @ hb.T > 0

    cells = F.array_sort(F.collect_list(F.struct(F.col(col).cast("string").alias("c"), F.col(value).cast("double").alias("v"))))
    rows = (long.groupBy(F.col(row).cast("string").alias("k")).agg(cells.alias("p"))
            .select("k", F.transform("p", lambda s: s["c"]).alias("c"), F.transform("p", lambda s: s["v"]).alias("v")))
    return tiled_pairs(rows, tile, "dist")


# ------------------------------------------------------------------- D13

def _centred(pdf: pd.DataFrame) -> np.ndarray:
    x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
    return x - x.mean(axis=1, keepdims=True)


def _times(rows: DataFrame, Q: np.ndarray) -> np.ndarray:
    """X'(X Q) of the centred rows X: tasks send their m x l sums, Spark adds them up."""
    shared = rows.sparkSession.sparkContext.broadcast(Q)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = None
        for pdf in it:
            if len(pdf):
                x = _centred(pdf)
                part = x.T @ (x @ shared.value)
                acc = part if acc is None else acc + part
        if acc is not None:
            i, j = np.indices(acc.shape)
            yield pd.DataFrame({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "z": acc.ravel()})

    out = np.zeros(Q.shape)
    for r in rows.mapInPandas(run, "i int, j int, z double").groupBy("i", "j").agg(F.sum("z").alias("z")).collect():      # m x l numbers
        out[r["i"], r["j"]] = r["z"]
    return out


def tsqr(rows: DataFrame, Q: np.ndarray, fan_in: int = 32) -> np.ndarray:
    """R of the QR decomposition of X Q (X: the centred rows), by a tree: each task decomposes its rows, then
    groups of ``fan_in`` factors are stacked and decomposed again until one is left. A factor is l x l."""
    shared, l = rows.sparkSession.sparkContext.broadcast(Q), Q.shape[1]
    schema = "part long, r array<double>"

    def factor(y: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(y, mode="r")
        return np.vstack([r, np.zeros((l - len(r), l))]) if len(r) < l else r

    def leaf(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        r = None
        for pdf in it:
            if len(pdf):
                y = _centred(pdf) @ shared.value
                r = factor(y if r is None else np.vstack([r, y]))
        if r is not None:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "r": [r.ravel()]})

    def node(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "r": [factor(np.vstack([np.asarray(r).reshape(l, l) for r in pdf.sort_values("part")["r"]])).ravel()]})

    level = rows.mapInPandas(leaf, schema)
    width = 1 + (rows.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] or 0)
    while width > fan_in:
        level = level.groupBy(F.floor(F.col("part") / fan_in).cast("long").alias("up")).applyInPandas(node, schema)
        width = -(-width // fan_in)
    last = sorted(level.collect(), key=lambda r: r["part"])                        # at most fan_in factors
    return factor(np.vstack([np.asarray(r["r"]).reshape(l, l) for r in last])) if last else np.zeros((l, l))


def pca(vst_vec: DataFrame, n_samples: int, k: int = 2, vec: str = "v", oversampling: int = 30, tolerance: float = 1e-9,
        max_rounds: int = 200, seed: int = 5) -> tuple[DataFrame, list[float]]:
    """PCA of samples over genes with k components, by randomised subspace iteration.

    Genes are rows X, centred where they are read. A random m x (k + oversampling) basis is multiplied by X'X (one Spark
    aggregate a round) and made orthonormal until the k leading values settle; then a tree QR (TSQR) of X Q gives
    singular values and directions. Nothing larger than m x (k + oversampling) reaches the driver, whatever the samples.
    scores = direction x singular value, explained ratio = its square over the sum of squares. Sign: each component's
    largest absolute score is positive. Returns (scores long: sample_idx, pc, score), ratios.
    """
    from helixframe.session import cut_lineage
    rows = cut_lineage(vst_vec.select(F.col(vec).alias("v")).where(F.col(vec).isNotNull()))
    spark, k = vst_vec.sparkSession, min(k, n_samples)
    width = min(n_samples, k + oversampling)
    Q = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_samples, width)))[0]
    before = None
    for _ in range(max_rounds):
        Q, R = np.linalg.qr(_times(rows, Q))
        now = np.abs(np.diag(R))[:k]
        if width == n_samples or before is not None and np.all(np.abs(now - before) <= tolerance * max(now.max(initial=0.0), 1e-300)):
            break
        before = now
    _, sigma, Vt = np.linalg.svd(tsqr(rows, Q))
    V = (Q @ Vt.T)[:, :k]
    sigma = sigma[:k]
    for c in range(V.shape[1]):
        if V[np.argmax(np.abs(V[:, c])), c] < 0:
            V[:, c] = -V[:, c]
    scores = V * sigma[None, :]
    mean = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / F.size("v")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) - F.size("v") * mean * mean
    total = float(rows.agg(F.sum(squares)).first()[0] or 0.0)
    ratios = [float(x * x / total) if total > 0 else 0.0 for x in sigma]
    out = [(int(s), int(c + 1), float(scores[s, c])) for s in range(n_samples) for c in range(V.shape[1])]
    return spark.createDataFrame(out, "sample_idx int, pc int, score double"), ratios
