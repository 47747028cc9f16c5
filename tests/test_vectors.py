"""Vector operators: exact k-NN against brute force, normalisation, collections."""

import numpy as np
from pyspark.sql import functions as F

from helixframe.functions import vectors as VF
from helixframe.operators import vectors as V


def test_knn_exact_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    base[10] = base[11] = base[12]          # exact ties broken by id
    stored = spark.createDataFrame([(f"{i:03d}", list(map(float, v))) for i, v in enumerate(base)],
                                   "id string, embedding array<double>").repartition(5)
    qs = rng.normal(size=(4, 8))
    qs[0] = base[12] + 1e-3
    q = spark.createDataFrame([(f"q{i}", list(map(float, v))) for i, v in enumerate(qs)],
                              "query_id string, embedding array<double>")
    got = {}
    for r in V.knn_exact(stored, q, 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id))
    for i, qv in enumerate(qs):
        d = ((base - qv) ** 2).sum(1)
        order = sorted(range(60), key=lambda j: (round(d[j], 9), f"{j:03d}"))[:5]
        assert [x[1] for x in sorted(got[f"q{i}"])] == [f"{j:03d}" for j in order]


def test_knn_blocks_and_many_batches_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(V, "ROW_BLOCK", 7)
    monkeypatch.setattr(V, "QUERY_BLOCK", 3)
    monkeypatch.setattr(V, "STORED_BLOCK", 40)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 3, size=(150, 4)).astype(float)                # many ties
    qs = rng.integers(0, 3, size=(10, 4)).astype(float)
    stored = spark.createDataFrame([(f"{i:03d}", list(map(float, v)), f"x{i}") for i, v in enumerate(base)] + [("nul", None, "x")],
                                   "id string, embedding array<double>, e string").coalesce(2)
    q = spark.createDataFrame([(f"q{i}", list(map(float, v))) for i, v in enumerate(qs)], "query_id string, embedding array<double>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = {(r.query_id, r["rank"]): (r.id, r.e) for r in V.knn_exact(stored, q, 6, extra=["e"]).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for i, qv in enumerate(qs):
        d = ((base - qv) ** 2).sum(1)
        for n, j in enumerate(sorted(range(150), key=lambda j: (round(d[j], 9), j))[:6]):
            assert got[f"q{i}", n + 1] == (f"{j:03d}", f"x{j}")


def test_knn_smaller_collection_returns_fewer(spark):
    stored = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "id string, embedding array<double>")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    assert V.knn_exact(stored, q, 5).count() == 2


def test_l2_normalize_zero_is_null(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    r = df.select(VF.l2_normalize("v").alias("u")).collect()
    assert r[0].u == [0.6, 0.8] and r[1].u is None


def test_centroids_renormalised(spark):
    df = spark.createDataFrame([("g", [1.0, 0.0]), ("g", [0.0, 1.0]), ("h", [2.0, 0.0])],
                               "gene string, embedding array<double>")
    c = {r.gene: r.centroid for r in V.centroids(df).collect()}
    assert np.allclose(c["g"], [2 ** -0.5, 2 ** -0.5]) and np.allclose(c["h"], [1.0, 0.0])


def test_hashed_embedding_is_deterministic_and_unit(spark):
    df = spark.createDataFrame([("1", "alpha beta Beta"), ("2", ""), ("3", "alpha beta beta")], "k string, t string")
    r = {x.k: x.embedding for x in V.embed_hashed(df, "t", "k").collect()}
    assert r["2"] is None
    assert np.allclose(r["1"], r["3"]) and abs(np.linalg.norm(r["1"]) - 1) < 1e-12


def test_collection_upsert_semantics(spark, tmp_path):
    from helixframe.sources import collection as COL
    root = str(tmp_path)
    empty = COL.open_collection(spark, root, "c")
    assert empty.count() == 0 and not (tmp_path / "c").exists()          # reading creates nothing
    meta = F.struct(F.lit(2020).alias("year"), F.lit("J").alias("journal"), F.lit(None).cast("string").alias("gene"))
    rows1 = spark.createDataFrame([("1", "a", [1.0]), ("2", "b", [2.0])], "id string, document string, embedding array<double>") \
        .withColumn("metadata", meta)
    COL.upsert(spark, root, "c", rows1)
    rows2 = spark.createDataFrame([("2", "b2", [3.0], 1), ("2", "b3", [4.0], 2), ("3", "c", [5.0], 1)],
                                  "id string, document string, embedding array<double>, o int").withColumn("metadata", meta)
    live = COL.upsert(spark, root, "c", rows2, order_col="o")
    got = {r.id: r.document for r in live.collect()}
    assert got == {"1": "a", "2": "b3", "3": "c"}
    assert {r.id for r in COL.open_collection(spark, root, "c").collect()} == {"1", "2", "3"}


def test_stream_batch_replay_is_idempotent(spark, tmp_path):
    """ST1: running the same foreachBatch body twice (a replay after failure) leaves the same collection."""
    from helixframe.sources import collection as COL
    from helixframe.streaming.incremental import upsert_batch
    recs = spark.createDataFrame(
        [("1", "T one", "alpha beta", 2001, "J", ["m"]), ("2", "T two", "gamma", None, "J", [])],
        "pmid string, title string, abstract string, year int, journal string, mesh_major_topics array<string>")
    recs = recs.select(F.lit("<x/>").alias("xml"), F.lit(None).cast("string").alias("reason"), F.struct("*").alias("record"))
    broken = spark.createDataFrame([("<y",)], "xml string").select("xml", F.lit("malformed").alias("reason"), F.lit(None).cast(recs.schema["record"].dataType).alias("record"))
    recs = recs.unionByName(broken)
    run = upsert_batch(spark, str(tmp_path), "c", rejects=str(tmp_path / "rejects"))
    run(recs, 0)
    first = sorted((r.id, r.document) for r in COL.open_collection(spark, str(tmp_path), "c").collect())
    run(recs, 0)
    again = sorted((r.id, r.document) for r in COL.open_collection(spark, str(tmp_path), "c").collect())
    assert first == again == [("1", "T one\n\nalpha beta"), ("2", "T two\n\ngamma")]
    assert [(r.xml, r.batch_id) for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == [("<y", 0)]


def test_stream_drops_articles_sent_again(spark, tmp_path):
    """ST1: a pmid that comes again, in the same drop or later, leaves the stream once; rejects are all kept."""
    from test_xml_records import ART
    from helixframe.streaming import incremental as I
    art = lambda k, t: ART.format(pmid=str(k), date="<Year>2011</Year>", title=t, abstract="", authors="", ids="")
    drops, out, ckpt, side = (str(tmp_path / x) for x in ("drops", "out", "ckpt", "rejects"))

    def send(name, rows):
        spark.createDataFrame([(r,) for r in rows], "xml string").write.parquet(f"{drops}/{name}")

    seen = []

    def count_batch(batch, batch_id):
        rows = batch.select("reason", "record.pmid").collect()
        seen.append(sorted((r.pmid, r.reason) for r in rows if r.reason is None))
        seen[-1] += [r.reason for r in rows if r.reason]

    def run():
        before = spark.conf.get(I.STATE_STORE, None)
        spark.conf.set(I.STATE_STORE, I.ROCKSDB)
        q = I.corpus_stream(spark, drops).writeStream.foreachBatch(count_batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        spark.conf.unset(I.STATE_STORE) if before is None else spark.conf.set(I.STATE_STORE, before)

    send("d1", [art(1, "a"), art(1, "a"), art(2, "b"), "broken", "broken"])
    run()
    send("d2", [art(2, "changed"), art(3, "c"), "broken"])
    run()
    assert [x for x in seen if x] == [[("1", None), ("2", None), "malformed", "malformed"], [("3", None), "malformed"]]
    live = I.ingest_increment(spark, drops, out, "c", str(tmp_path / "ckpt2"), rejects=side)
    assert sorted(r.id for r in live.collect()) == ["1", "2", "3"] and spark.read.parquet(side).count() == 3
    assert I.ingest_increment(spark, drops, out, "c", str(tmp_path / "ckpt2"), rejects=side).count() == 3


def test_hashed_vectors_belong_to_rows_not_keys(spark):
    df = spark.createDataFrame([("1", "alpha"), ("1", "beta gamma"), ("2", None)], "k string, t string")
    rows = V.embed_hashed(df, "t", "k")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = [r.embedding for r in rows.collect()]
    assert got[0] != got[1] and got[2] is None
    assert all(abs(np.linalg.norm(v) - 1) < 1e-12 for v in got[:2])


def _rows(spark, n, tag):
    meta = F.struct(F.lit(2020).alias("year"), F.lit("J").alias("journal"), F.lit(None).cast("string").alias("gene"))
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.concat(F.lit(tag), F.col("id").cast("string")).alias("document"),
                                 F.array(F.col("id").cast("double")).alias("embedding"), meta.alias("metadata"))


def test_collection_survives_a_dead_writer(spark, tmp_path):
    """Whatever a job that dies leaves behind, the version before it stays live and the next upsert works."""
    from helixframe.sources import collection as COL
    root = str(tmp_path)
    COL.upsert(spark, root, "c", _rows(spark, 50, "a"))
    base = tmp_path / "c"
    (base / "v=1-dead" / "bucket=0").mkdir(parents=True)                 # data written, manifest missing
    (base / "manifest-1.txt.abc.tmp").write_text("half")                 # manifest not yet renamed
    assert COL.open_collection(spark, root, "c").count() == 50
    live = COL.upsert(spark, root, "c", _rows(spark, 10, "b"))
    docs = {r.id: r.document for r in live.collect()}
    assert len(docs) == 50 and docs["3"] == "b3" and docs["30"] == "a30"
    import pytest
    from helixframe.sources import versioned
    with pytest.raises(RuntimeError):                                     # a version is never replaced
        versioned.add_text(spark, str(base / "manifest-1.txt"), "x")


def test_collection_is_dealt_anew_when_it_outgrows_its_buckets(spark, tmp_path, monkeypatch):
    from helixframe.sources import collection as COL
    monkeypatch.setattr(COL, "BUCKET_ROWS", 10)
    root = str(tmp_path)
    COL.upsert(spark, root, "c", _rows(spark, 10, "a"))
    assert COL._manifest(spark, str(tmp_path / "c"))[1][-1] == "1"
    live = COL.upsert(spark, root, "c", _rows(spark, 120, "b"))
    assert int(COL._manifest(spark, str(tmp_path / "c"))[1][-1]) == 13
    assert live.count() == 120 and {r.document[0] for r in live.collect()} == {"b"}


def test_knn_of_no_queries_has_the_same_columns(spark):
    stored = spark.createDataFrame([("a", [1.0], "g")], "id string, embedding array<double>, gene string")
    none = spark.createDataFrame([], "query_id string, embedding array<double>")
    some = spark.createDataFrame([("q", [1.0])], "query_id string, embedding array<double>")
    assert V.knn_exact(stored, none, 3, extra=["gene"]).columns == V.knn_exact(stored, some, 3, extra=["gene"]).columns
    assert V.knn_exact(stored, none, 3, extra=["gene"]).count() == 0


def test_ingest_rows_raises_on_unmatched_keys(spark):
    import pytest
    recs = spark.createDataFrame([("1", "T", "A", 2000, "J")], "pmid string, title string, abstract string, year int, journal string")
    vecs = spark.createDataFrame([("2", [1.0])], "pmid string, embedding array<double>")
    with pytest.raises(Exception, match="same keys"):
        V.ingest_rows(recs, vecs).collect()


def test_lsh_neighbours_are_mostly_the_exact_ones(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    qs = base[:20] + 0.02 * rng.normal(size=(20, 16))
    stored = spark.createDataFrame([(f"{i:03d}", list(map(float, v))) for i, v in enumerate(base)], "id string, embedding array<double>")
    q = spark.createDataFrame([(f"q{i}", list(map(float, v))) for i, v in enumerate(qs)], "query_id string, embedding array<double>")
    got = V.knn_lsh(stored, q, 1, num_tables=16)
    assert sum(r.id == f"{int(r.query_id[1:]):03d}" for r in got.collect()) >= 18


def test_documents_stay_out_of_the_text_search(spark, tmp_path, monkeypatch):
    from helixframe.sources import collection as COL
    meta = F.struct(F.lit(2020).alias("year"), F.lit("J").alias("journal"), F.lit(None).cast("string").alias("gene"))
    texts = spark.createDataFrame([("1", "alpha beta"), ("2", "gamma delta"), ("3", "")], "id string, document string")
    rows = V.embed_hashed(texts.withColumn("t", F.col("document")), "t", "id").withColumn("metadata", meta)
    COL.upsert(spark, str(tmp_path), "c", rows)
    seen, search = [], V.knn_exact

    def watched(stored, *a, **kw):
        seen.append(stored.columns)
        return search(stored, *a, **kw)

    monkeypatch.setattr(V, "knn_exact", watched)
    q = spark.createDataFrame([("q1", "gamma delta"), ("q2", "beta alpha"), ("q3", "")], "query_id string, text string")
    for most in (100_000, 0):
        monkeypatch.setattr(COL, "BROADCAST_HITS", most)
        got = {(r.query_id, r["rank"]): (r.id, r.document, r.metadata.year) for r in COL.query_text(spark, str(tmp_path), "c", q, 5).collect()}
        assert got["q1", 1] == ("2", "gamma delta", 2020) and got["q2", 1] == ("1", "alpha beta", 2020)
        assert sorted(got) == [("q1", 1), ("q1", 2), ("q2", 1), ("q2", 2)]
    assert all(c == ["id", "embedding"] for c in seen)


def test_a_search_encodes_each_text_once(spark):
    texts = spark.createDataFrame([("1", "alpha beta"), ("2", None)], "k string, t string")
    asked = spark.createDataFrame([("q", [1.0] * 64)], "query_id string, embedding array<double>")
    found = V.knn_exact(V.embed_hashed(texts, "t", "k"), asked, 5, id_col="k")
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.id for r in found.collect()] == ["1"]
