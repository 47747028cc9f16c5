"""Registered queries over vectors: the ``embeddings`` table and hashed embeddings of the corpus."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from helixframe.functions import text as T
from helixframe.functions import vectors as VF
from helixframe.operators import corpus as C
from helixframe.operators import vectors as V
from helixframe.plans import adapters as A
from helixframe.plans.oracle import cte
from helixframe.session import cut_lineage

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def _r6(c):
    return F.round(c, 6)


# --------------------------------------------------------------- SQL pieces

_VEC_LONG = """
vlong AS (SELECT id, gene, CAST(i - 1 AS INTEGER) AS dim, CAST(embedding[i] AS DOUBLE) AS x
          FROM vectors, range(1, len(embedding) + 1) t(i)),
vnorm AS (SELECT id, gene, dim, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM vlong)"""

_CENTROIDS = _VEC_LONG + """,
cm AS (SELECT gene, CAST(dim AS INTEGER) AS dim, avg(CAST(embedding[dim + 1] AS DOUBLE)) AS x
       FROM vectors, range(0, 64) t(dim) GROUP BY gene, dim),
cen AS (SELECT gene, dim, x / sqrt(sum(x * x) OVER (PARTITION BY gene)) AS x FROM cm)"""


def _hash_sql(name: str, text_expr: str, src: str, key: str) -> str:
    return f"""
{name}_c AS (SELECT key, (('0x' || substr(md5(t), 1, 4))::INTEGER % 64) AS dim, count(*) AS c
        FROM (SELECT {key} AS key, unnest(list_filter(regexp_split_to_array(lower({text_expr}), '[^\\p{{L}}\\p{{N}}]+'),
                                                 lambda t: length(t) > 0)) AS t FROM {src})
        GROUP BY ALL),
{name} AS (SELECT key, dim, c / sqrt(sum(c * c) OVER (PARTITION BY key)) AS x FROM {name}_c)"""


_TEXT_BASE = "title || chr(10) || chr(10) || abstract"
_TEXT_MESH = ("title || chr(10) || chr(10) || abstract || CASE WHEN len(mesh_major_topics) > 0 THEN chr(10) || chr(10) "
              "|| 'MeSH: ' || array_to_string(mesh_major_topics, '; ') ELSE '' END")


def _knn_sql(q: str, s: str, k: int = 5) -> str:
    """Exact top-k by squared L2 over long sparse vectors (every pair scored)."""
    return f"""(SELECT query_id, rank, id, distance FROM (
   SELECT qq.key AS query_id, ss.key AS id,
          greatest(qq.n + ss.n - 2 * coalesce(dd.dot, 0), 0) AS distance,
          CAST(row_number() OVER (PARTITION BY qq.key ORDER BY round(greatest(qq.n + ss.n - 2 * coalesce(dd.dot, 0), 0), 9), ss.key) AS INTEGER) AS rank
   FROM (SELECT key, sum(x * x) AS n FROM {q} GROUP BY key) qq
   CROSS JOIN (SELECT key, sum(x * x) AS n FROM {s} GROUP BY key) ss
   LEFT JOIN (SELECT a.key AS qk, b.key AS sk, sum(a.x * b.x) AS dot FROM {q} a JOIN {s} b USING (dim) GROUP BY ALL) dd
     ON dd.qk = qq.key AND dd.sk = ss.key) WHERE rank <= {k})"""


# --------------------------------------------------------------- Spark pieces

def corpus_vectors(spark, d, builder=T.text_base):
    r = A.corpus_records(spark, d).select("pmid", builder().alias("text"), "year", "journal")
    return V.embed_hashed(r, "text", "pmid")


def benchmark_queries(spark, d):
    from helixframe.sources.tables import read_table
    b = read_table(spark, d, "benchmark", "item_id", "text")
    return V.embed_hashed(b.select(F.col("item_id").cast("string").alias("query_id"), "text"), "text", "query_id")


def _long(df, key, vec="embedding"):
    return df.select(F.col(key).alias("key"), F.posexplode(vec).alias("dim", "x"))


# --------------------------------------------------------------- V2 / V3 / V4 / V5

@register("l2_normalize", cte("vectors", extra=_VEC_LONG) + """
SELECT id, dim, round(x, 6) AS x FROM vnorm""")
def q_l2_normalize(spark, d):
    v = A.vector_rows(spark, d).select("id", VF.l2_normalize("embedding").alias("u"))
    return v.select("id", F.posexplode("u").alias("dim", "x")).select("id", "dim", _r6("x").alias("x"))


@register("cosine_pairs", cte("vectors", extra=_VEC_LONG + """,
ranked AS (SELECT id, gene, row_number() OVER (PARTITION BY gene ORDER BY CAST(id AS BIGINT)) AS r FROM vectors),
g AS (SELECT DISTINCT gene, CAST(substr(gene, 2) AS INTEGER) AS gi FROM vectors),
ng AS (SELECT gene, coalesce(lead(gene) OVER (ORDER BY gi), first_value(gene) OVER (ORDER BY gi)) AS next_gene FROM g),
trip AS (SELECT ng.gene, a.id AS a, b.id AS b, c.id AS c FROM ng
         JOIN ranked a ON a.gene = ng.gene AND a.r = 1 JOIN ranked b ON b.gene = ng.gene AND b.r = 2
         JOIN ranked c ON c.gene = ng.next_gene AND c.r = 1),
dots AS (SELECT t.gene, sum(CASE WHEN y.id = t.b THEN x.x * y.x END) AS related,
                sum(CASE WHEN y.id = t.c THEN x.x * y.x END) AS control
         FROM trip t JOIN vnorm x ON x.id = t.a JOIN vnorm y ON (y.id = t.b OR y.id = t.c) AND y.dim = x.dim
         GROUP BY t.gene)""") + """
SELECT gene, round(related, 6) AS sim_related, round(control, 6) AS sim_control, round(related - control, 6) AS margin
FROM dots""")
def q_cosine_pairs(spark, d):
    """V3: per gene, cosine of its first two vectors vs its first and the next gene's first (control)."""
    v = A.vector_rows(spark, d).withColumn("u", VF.l2_normalize("embedding"))
    v = v.withColumn("gi", F.substr("gene", F.lit(2)).cast("int"))
    r = v.withColumn("r", F.row_number().over(Window.partitionBy("gene").orderBy(F.col("id").cast("bigint"))))
    firsts = r.where("r = 1").select("gene", "gi", F.col("u").alias("ua"))
    seconds = r.where("r = 2").select("gene", F.col("u").alias("ub"))
    from helixframe.session import require_small
    require_small(firsts, V.MAX_CENTROIDS, "label list")   # the ordering window below spans all labels
    nxt = firsts.select(F.col("gene").alias("cg"), F.col("gi").alias("cgi"), F.col("ua").alias("uc"))
    # control gene = next label id, wrapping to the smallest (labels form a short, bounded list)
    order = nxt.withColumn("pos", F.row_number().over(Window.orderBy("cgi")))
    n_lab = F.max("pos").over(Window.partitionBy())
    order = order.withColumn("prev_pos", F.when(F.col("pos") == 1, n_lab).otherwise(F.col("pos") - 1))
    base = firsts.join(seconds, "gene").join(
        order.select("cgi", "pos"), firsts.gi == F.col("cgi")).select("gene", "ua", "ub", F.col("pos").alias("p"))
    ctrl = order.select(F.col("prev_pos").alias("p"), "uc")
    j = base.join(ctrl, "p")
    rel, con = VF.dot("ua", "ub"), VF.dot("ua", "uc")
    return j.select("gene", _r6(rel).alias("sim_related"), _r6(con).alias("sim_control"), _r6(rel - con).alias("margin"))


@register("gene_centroids", cte("vectors", extra=_CENTROIDS) + """
SELECT gene, dim, round(x, 6) AS x FROM cen""")
def q_gene_centroids(spark, d):
    c = V.centroids(A.vector_rows(spark, d))
    return c.select("gene", F.posexplode("centroid").alias("dim", "x")).select("gene", "dim", _r6("x").alias("x"))


@register("gene_similarity", cte("vectors", extra=_CENTROIDS) + """
SELECT a.gene AS a, b.gene AS b, round(sum(a.x * b.x), 6) AS sim FROM cen a JOIN cen b USING (dim) GROUP BY ALL""")
def q_gene_similarity(spark, d):
    s = V.similarity_matrix(V.centroids(A.vector_rows(spark, d)))
    return s.select("a", "b", _r6("sim").alias("sim"))


# --------------------------------------------------------------- V6 / J7 / W7

@register("knn_exact", cte("vectors", extra=_CENTROIDS + """,
sl AS (SELECT id AS key, dim, CAST(x AS DOUBLE) AS x FROM vlong),
ql AS (SELECT gene AS key, dim, x FROM cen)""") + """
SELECT query_id, rank, id, round(distance, 6) AS distance FROM """ + _knn_sql("ql", "sl"))
def q_knn_exact(spark, d):
    """V6: the 5 stored vectors nearest to each gene centroid."""
    vr = A.vector_rows(spark, d)
    cen = V.centroids(vr).select(F.col("gene").alias("query_id"), F.col("centroid").alias("embedding"))
    k = V.knn_exact(vr, cen, 5)
    return k.select("query_id", "rank", "id", _r6("distance").alias("distance"))


# --------------------------------------------------------------- V1 hashed

@register("embed_hashed", cte("corpus", extra=_hash_sql("emb", _TEXT_BASE, "corpus", "pmid")) + """
SELECT key AS pmid, dim, round(x, 6) AS x FROM emb""")
def q_embed_hashed(spark, d):
    e = corpus_vectors(spark, d)
    return e.select("pmid", F.posexplode("embedding").alias("dim", "x")).where("x <> 0") \
        .select("pmid", "dim", _r6("x").alias("x"))


# --------------------------------------------------------------- V8 / J8 / P21

_ABL = (_hash_sql("ea", _TEXT_BASE, "corpus", "pmid") + "," + _hash_sql("eb", _TEXT_MESH, "corpus", "pmid") + "," +
        _hash_sql("eq", "text", "benchmark", "CAST(item_id AS VARCHAR)") + """,
gn AS (SELECT pmid, string_agg(gene, '; ' ORDER BY gene_ord, hit_ord) AS gene FROM flat GROUP BY pmid),
ka AS """ + _knn_sql("eq", "ea") + """,
kb AS """ + _knn_sql("eq", "eb"))


@register("ablation_side_by_side", cte("corpus", "flat", extra=_ABL) + """
SELECT ka.query_id, ka.rank, ka.id AS id_a, kb.id AS id_b,
       ka.id || ' | ' || coalesce(ga.gene, '?') || ' | d=' || printf('%.3f', ka.distance) AS label_a,
       kb.id || ' | ' || coalesce(gb.gene, '?') || ' | d=' || printf('%.3f', kb.distance) AS label_b
FROM ka JOIN kb USING (query_id, rank) LEFT JOIN gn ga ON ga.pmid = ka.id LEFT JOIN gn gb ON gb.pmid = kb.id""")
def q_ablation_side_by_side(spark, d):
    """V8 + J8 + P21: benchmark texts against two collections (title+abstract, and +MeSH)."""
    a, b = _ablation_sides(spark, d)
    j = V.rank_join(a, b)
    return j.select("query_id", "rank", "id_a", "id_b",
                    T.hit_label("id_a", "gene_a", "distance_a").alias("label_a"),
                    T.hit_label("id_b", "gene_b", "distance_b").alias("label_b"))


def _ablation_sides(spark, d):
    q = benchmark_queries(spark, d)
    flat = C.flatten_hits(C.search_corpus(A.corpus_records(spark, d), A.search_terms(spark, d)),
                          A.corpus_records(spark, d))
    # found once for both sides; the hits of a side fetch their genes, not the collection
    genes = cut_lineage(C.dedup_records(flat).select(F.col("pmid").alias("__p"), F.col("genes").alias("gene")))
    sides = []
    for builder in (T.text_base, T.text_with_mesh):
        coll = corpus_vectors(spark, d, builder)
        hits = V.knn_exact(coll, q, 5, id_col="pmid")
        sides.append(hits.join(genes, F.col("id") == F.col("__p"), "left").drop("__p"))
    return sides


@register("ablation_overlap", cte("corpus", "flat", extra=_ABL) + """
SELECT query_id, count(*) FILTER (WHERE da IS NOT NULL AND db IS NOT NULL) AS overlap,
       round(max(abs(da - db)), 6) AS max_shift
FROM (SELECT coalesce(ka.query_id, kb.query_id) AS query_id, ka.distance AS da, kb.distance AS db
      FROM ka FULL OUTER JOIN kb ON ka.query_id = kb.query_id AND ka.id = kb.id) GROUP BY query_id""")
def q_ablation_overlap(spark, d):
    a, b = _ablation_sides(spark, d)
    o = V.ablation_overlap(a, b)
    return o.select("query_id", "overlap", _r6("max_shift").alias("max_shift"))


# --------------------------------------------------------------- J6 / S9 / S10

@register("ingest_rows", cte("corpus", "flat", extra="""
gn AS (SELECT pmid, string_agg(gene, '; ' ORDER BY gene_ord, hit_ord) AS gene FROM flat GROUP BY pmid)""") + """
SELECT pmid AS id, md5(title || chr(10) || chr(10) || abstract) AS doc_md5, year, journal, gn.gene
FROM corpus LEFT JOIN gn USING (pmid)""")
def q_ingest_rows(spark, d):
    """Records x vectors x dedup genes -> collection rows (keyed, not zipped)."""
    recs = A.corpus_records(spark, d)
    vecs = corpus_vectors(spark, d).select("pmid", "embedding")
    flat = C.flatten_hits(C.search_corpus(recs, A.search_terms(spark, d)), recs)
    genes = C.dedup_records(flat).select("pmid", "genes")
    rows = V.ingest_rows(recs, vecs, genes)
    return rows.select("id", F.md5("document").alias("doc_md5"), "metadata.year", "metadata.journal", "metadata.gene")


@register("collection_upsert", cte("corpus") + """
SELECT pmid AS id, CASE WHEN journal = 'Journal of src1' THEN md5(""" + _TEXT_MESH + """)
                        ELSE md5(title || chr(10) || chr(10) || abstract) END AS doc_md5 FROM corpus""")
def q_collection_upsert(spark, d):
    """S9 + S10: create a collection from all records, upsert one journal's records
    with the MeSH text; the upserted version wins on shared ids."""
    from helixframe.session import scratch_path
    from helixframe.sources import collection as COL
    root = scratch_path(spark, "collections")
    recs = A.corpus_records(spark, d)
    COL.upsert(spark, root, "abstracts", V.ingest_rows(recs, corpus_vectors(spark, d).select("pmid", "embedding")))
    batch_recs = recs.where(F.col("journal") == "Journal of src1")
    batch_vecs = corpus_vectors(spark, d, T.text_with_mesh).where(F.col("journal") == "Journal of src1")
    batch = V.ingest_rows(batch_recs, batch_vecs.select("pmid", "embedding"), text_builder=T.text_with_mesh)
    live = COL.upsert(spark, root, "abstracts", batch)
    return live.select("id", F.md5("document").alias("doc_md5"))


def _stored_corpus(spark, d) -> str:
    """All records written as the collection ``abstracts``; returns its root."""
    from helixframe.session import scratch_path
    from helixframe.sources import collection as COL
    root = scratch_path(spark, "collections")
    COL.upsert(spark, root, "abstracts", V.ingest_rows(A.corpus_records(spark, d), corpus_vectors(spark, d).select("pmid", "embedding")))
    return root


@register("collection_open", cte("corpus") + """
SELECT pmid AS id, md5(title || chr(10) || chr(10) || abstract) AS doc_md5, year, journal FROM corpus""")
def q_collection_open(spark, d):
    """A stored collection opened by name (a name never written opens as no rows)."""
    from helixframe.sources import collection as COL
    root = _stored_corpus(spark, d)
    c = COL.open_collection(spark, root, "abstracts").unionByName(COL.open_collection(spark, root, "never written"))
    return c.select("id", F.md5("document").alias("doc_md5"), "metadata.year", "metadata.journal")


@register("collection_query", cte("corpus", extra=_hash_sql("ea", _TEXT_BASE, "corpus", "pmid") + "," +
                                  _hash_sql("eq", "text", "benchmark", "CAST(item_id AS VARCHAR)") + """,
ka AS """ + _knn_sql("eq", "ea")) + """
SELECT ka.query_id, ka.rank, ka.id, round(ka.distance, 6) AS distance, md5(title || chr(10) || chr(10) || abstract) AS doc_md5, year
FROM ka JOIN corpus ON corpus.pmid = ka.id""")
def q_collection_query(spark, d):
    """V6 over S9: benchmark texts as text queries against the stored collection."""
    from helixframe.sources import collection as COL
    from helixframe.sources.tables import read_table
    q = read_table(spark, d, "benchmark", "item_id", "text")
    r = COL.query_text(spark, _stored_corpus(spark, d), "abstracts", q, 5, "item_id")
    return r.select("query_id", "rank", "id", _r6("distance").alias("distance"), F.md5("document").alias("doc_md5"), "metadata.year")


@register("knn_lsh_recall")
def q_knn_lsh_recall(spark, d):
    """V7: LSH candidates + exact re-rank, recall@5 against V6 per centroid query (rows-only)."""
    vr = A.vector_rows(spark, d)
    cen = V.centroids(vr).select(F.col("gene").alias("query_id"), F.col("centroid").alias("embedding"))
    ex = V.knn_exact(vr, cen, 5)
    ap = V.knn_lsh(vr, cen, 5, threshold=1.5)
    return V.recall_at_k(ex, ap)


@register("knn_ivf", cte("vectors", extra=_CENTROIDS + """,
sl AS (SELECT id AS key, dim, CAST(x AS DOUBLE) AS x FROM vlong),
ql AS (SELECT gene AS key, dim, x FROM cen)""") + """
SELECT query_id, rank, id, round(distance, 6) AS distance FROM """ + _knn_sql("ql", "sl"))
def q_knn_ivf(spark, d):
    """V7: the 5 stored vectors nearest to each gene centroid from an inverted file; cells are added until the triangle
    inequality leaves none, so the rows are those of the exact search."""
    vr = A.vector_rows(spark, d)
    cen = V.centroids(vr).select(F.col("gene").alias("query_id"), F.col("centroid").alias("embedding"))
    return V.knn_ivf(vr, cen, 5).select("query_id", "rank", "id", _r6("distance").alias("distance"))


@register("hit_labels", cte("vectors", extra=_CENTROIDS + """,
sl AS (SELECT id AS key, dim, CAST(x AS DOUBLE) AS x FROM vlong),
ql AS (SELECT gene AS key, dim, x FROM cen)""") + """
SELECT k.query_id, k.rank, k.id || ' | ' || coalesce(v.gene, '?') || ' | d=' || printf('%.3f', k.distance) AS label
FROM """ + _knn_sql("ql", "sl") + """ k JOIN vectors v ON v.id = k.id""")
def q_hit_labels(spark, d):
    """``id | gene | d=0.123`` labels of the k-NN hits of each gene centroid."""
    vr = A.vector_rows(spark, d)
    cen = V.centroids(vr).select(F.col("gene").alias("query_id"), F.col("centroid").alias("embedding"))
    k = V.knn_exact(vr, cen, 5, extra=["gene"])
    return k.select("query_id", "rank", T.hit_label("id", "gene", "distance").alias("label"))


def _trigram_encoder(texts):
    """A small stand-in encoder for the plug-in path: hashed character trigrams (numpy only)."""
    import numpy as np
    import zlib
    out = np.zeros((len(texts), 32), dtype=np.float32)
    for r, t in enumerate(texts):
        s = f"  {t.lower()}  "
        for i in range(len(s) - 2):
            out[r, zlib.crc32(s[i:i + 3].encode()) % 32] += 1.0
    return out


@register("embed_plugin", "SELECT item_id, 32 AS dim, 1.0::DOUBLE AS norm2 FROM benchmark")
def q_embed_plugin(spark, d):
    """A caller-supplied encoder run as an iterator pandas UDF (batches of 32 texts),
    rows L2-normalised float32; here over every benchmark text (its SQL twin checks length and norm)."""
    from helixframe.sources.tables import read_table
    b = read_table(spark, d, "benchmark", "item_id", "text")
    e = V.embed_with(b, "text", _trigram_encoder)
    return e.select("item_id", F.size("embedding").alias("dim"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm2"))
