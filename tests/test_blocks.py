"""Block joins over vectors: exact and inverted-file k-NN, tiles of similarities and distances, PCA by subspace iteration."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import explore as X
from helixframe.operators import vectors as V


def frame(spark, rows, key="id"):
    return spark.createDataFrame([(k, None if v is None else [float(x) for x in v]) for k, v in rows], f"{key} string, embedding array<double>")


def brute(rows, queries, k):
    out = {}
    for q, qv in queries:
        order = sorted(((round(float(((v - qv) ** 2).sum()), 9), i) for i, v in rows))[:k]
        for n, (_, i) in enumerate(order):
            out[q, n + 1] = i
    return out


def hits(df):
    return {(r.query_id, r["rank"]): r.id for r in df.collect()}


@pytest.mark.parametrize("cells", [1, 7, 40])
def test_inverted_file_gives_the_exact_neighbours(spark, monkeypatch, cells):
    monkeypatch.setattr(V, "STORED_BLOCK", 50)
    monkeypatch.setattr(V, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(cells)
    centers = rng.normal(size=(12, 6)) * 6
    rows = [(f"{i:04d}", centers[i % 12] + rng.normal(size=6)) for i in range(400)]
    rows += [(f"s{i:04d}", centers[0]) for i in range(200)]                       # a third in one place: a hot cell, all tied
    queries = [(f"q{i}", centers[i % 12] + 2 * rng.normal(size=6)) for i in range(30)]
    stored, asked = frame(spark, [*rows, ("none", None)]), frame(spark, [*queries, ("qnone", None)], "query_id")
    index = V.InvertedFile(stored, cells)
    got, cost = index.search(asked, 5)
    want = brute(rows, queries, 5)
    assert hits(got) == want == hits(V.knn_exact(stored, asked, 5))
    assert cost["all_pairs"] == 600 * 30
    if cells == 40:
        assert cost["pairs"] * 2 < cost["all_pairs"]
    # k above every cell's size, and above the number of rows
    assert hits(index.search(asked, 250)[0]) == brute(rows, queries, 250)
    few = V.InvertedFile(stored.filter("id < '0003'"), cells)
    assert hits(few.search(asked, 5)[0]) == brute(rows[:3], queries, 5)


def test_inverted_file_of_nothing(spark):
    some = frame(spark, [("a", [1, 2])], "query_id")
    assert V.knn_ivf(frame(spark, []), some).collect() == []
    assert V.knn_ivf(frame(spark, [("a", [1, 2])]), some.limit(0)).collect() == []


def test_inverted_file_with_tasks_without_rows(spark):
    """Splits of a file that hold no row group give tasks without rows; the rounds of the k-means take them."""
    rng = np.random.default_rng(4)
    rows = [(f"{i:03d}", rng.normal(size=4)) for i in range(200)]
    queries = [(f"q{i}", rng.normal(size=4)) for i in range(5)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "500")
    try:
        stored = frame(spark, rows).coalesce(1)
        assert hits(V.knn_ivf(stored, frame(spark, queries, "query_id"), 5)) == brute(rows, queries, 5)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_tiled_similarity_is_whole_and_symmetric(spark, monkeypatch):
    monkeypatch.setattr(V, "TILE", 9)
    rng = np.random.default_rng(2)
    rows = [(f"g{i}", rng.normal(size=5)) for i in range(50)]
    got = {(r.a, r.b): r.sim for r in V.similarity_matrix(frame(spark, [*rows, ("none", None)], "gene").repartition(3), vec="embedding").collect()}
    assert len(got) == 2500
    assert all(abs(got[a, b] - float(u @ v)) < 1e-12 and got[a, b] == got[b, a] for a, u in rows for b, v in rows)
    assert V.similarity_matrix(frame(spark, [], "gene"), vec="embedding").collect() == []


def test_tiled_distances_match_the_join_on_shared_columns(spark, monkeypatch):
    monkeypatch.setattr(V, "TILE", 4)
    rng = np.random.default_rng(3)
    cells = {}
    for r in range(14):
        for c in range(8):
            if rng.random() < 0.8 and not (r == 3 and c < 4) and not (r == 4 and c >= 4):
                cells[r, c] = None if r == 5 or rng.random() < 0.1 else float(rng.normal())
    for c in range(8):                                                            # a row and its nearly equal copy
        if (6, c) in cells:
            cells[20, c] = None if cells[6, c] is None else cells[6, c] * (1 + 1e-9)
    long = spark.createDataFrame([(f"r{r}", f"c{c}", v) for (r, c), v in cells.items()], "row string, col string, z double").repartition(3)
    got = {(r.a, r.b): r.dist for r in X.distance_matrix(long, "row", "col").collect()}
    want = {}
    for (r, c), v in cells.items():
        for (r2, c2), v2 in cells.items():
            if c == c2:
                want.setdefault((f"r{r}", f"r{r2}"), []).append(None if v is None or v2 is None else (v - v2) ** 2)
    assert set(got) == set(want)
    for key, parts in want.items():
        parts = [x for x in parts if x is not None]
        assert (got[key] is None) == (not parts)
        assert not parts or abs(got[key] - sum(parts) ** 0.5) < 1e-9


@pytest.mark.parametrize("samples,genes", [(60, 400), (8, 50), (30, 12)])
def test_pca_matches_numpy_svd(spark, samples, genes):
    rng = np.random.default_rng(samples)
    x = rng.normal(size=(genes, 4)) @ (rng.normal(size=(4, samples)) * np.array([[9], [4], [2], [1]])) + 0.3 * rng.normal(size=(genes, samples))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(6)
    scores, ratios = X.pca(df, samples, 3)
    _, s, vt = np.linalg.svd(x - x.mean(1, keepdims=True), full_matrices=False)
    assert np.allclose(ratios, (s ** 2 / (s ** 2).sum())[:3], atol=1e-8)
    for r in scores.collect():
        v = vt[r.pc - 1] * s[r.pc - 1]
        v = v if v[np.argmax(np.abs(v))] > 0 else -v
        assert abs(v[r.sample_idx] - r.score) < 1e-6 * s[0]


def test_tree_of_qr_factors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 7))
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(20).checkpoint()
    Q = rng.normal(size=(7, 4))
    r = X.tsqr(rows, Q, fan_in=3)
    y = (x - x.mean(1, keepdims=True)) @ Q
    assert np.allclose(r.T @ r, y.T @ y)
    assert X.tsqr(rows.filter(F.size("v") < 0).checkpoint(), Q).tolist() == np.zeros((4, 4)).tolist()


def test_text_queries_with_the_callers_encoder(spark):
    from helixframe.session import scratch_path
    from helixframe.sources import collection as COL

    def encode(texts):
        return np.array([[t.count("a"), t.count("b"), 1.0] for t in texts], np.float32)

    recs = spark.createDataFrame([("1", "aaa", "a"), ("2", "bbb", "b"), ("3", "ab", "ab")], "id string, title string, abstract string")
    docs = recs.select("id", F.concat("title", F.lit(" "), "abstract").alias("document"), F.lit(None).cast("int").alias("year"), F.lit("J").alias("journal"))
    rows = V.embed_with(docs, "document", encode).select("id", "document", F.col("embedding").cast("array<double>").alias("embedding"),
                                                         F.struct("year", "journal", F.lit(None).cast("string").alias("gene")).alias("metadata"))
    root = scratch_path(spark, "own-encoder")
    COL.upsert(spark, root, "c", rows)
    q = spark.createDataFrame([("x", "aaaa"), ("y", "bb b")], "query_id string, text string")
    got = {r.query_id: r.id for r in COL.query_text(spark, root, "c", q, 1, encoder=encode).collect()}
    assert got == {"x": "1", "y": "2"}
