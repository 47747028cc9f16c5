"""Registered queries over the citation corpus (documents -> records -> hits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import text as T
from helixframe.operators import corpus as C
from helixframe.plans import adapters as A
from helixframe.plans.oracle import cte
from helixframe.sources import xml_corpus as X

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def parsed_records(spark, d):
    """S5 path: documents rendered as citation XML, parsed back with from_xml."""
    return X.parse_xml_column(A.corpus_xml(spark, d))


def hits(spark, d):
    return C.search_corpus(A.corpus_records(spark, d), A.search_terms(spark, d))


def _flat(spark, d):
    return C.flatten_hits(hits(spark, d), A.corpus_records(spark, d))


@register("corpus_from_xml", cte("corpus") + """
SELECT pmid, title, abstract, array_to_string(authors, '; ') AS authors, year, doi, journal,
       array_to_string(mesh_major_topics, '; ') AS mesh_major_topics FROM corpus""")
def q_corpus_from_xml(spark, d):
    r = parsed_records(spark, d)
    return r.select("pmid", "title", "abstract", F.array_join("authors", "; ").alias("authors"), "year", "doi",
                    "journal", F.array_join("mesh_major_topics", "; ").alias("mesh_major_topics"))


@register("xml_rejects", """
SELECT source, outcome, count(*) AS n FROM (
  SELECT CASE WHEN doc_id % 11 = 0 THEN 'malformed' WHEN doc_id % 13 = 0 THEN 'no pmid' ELSE 'record' END AS outcome FROM documents),
  (VALUES ('column'), ('files')) AS s(source) GROUP BY ALL""")
def q_xml_rejects(spark, d):
    """S5 on a feed with broken articles, as a string column and as files: records by the parse, rejects by their reason."""
    from helixframe.session import scratch_path
    feed, base = A.damaged_xml(spark, d), scratch_path(spark, "xml_rejects")
    X.write_xml_documents(feed, f"{base}/files")
    column = X.parse_xml_column(feed, rejects=f"{base}/column-rejects")
    files = X.read_pubmed_xml(spark, f"{base}/files", rejects=f"{base}/files-rejects")

    def outcomes(records, source):
        rejects = spark.read.parquet(f"{base}/{source}-rejects")
        rows = records.select(F.lit("record").alias("outcome")).unionByName(rejects.select(F.col("reason").alias("outcome")))
        return rows.select(F.lit(source).alias("source"), "outcome")
    return outcomes(column, "column").unionByName(outcomes(files, "files")).groupBy("source", "outcome").agg(F.count("*").alias("n"))


@register("record_authors", cte("corpus") + """
SELECT pmid, array_to_string(authors, '; ') AS authors, CAST(len(authors) AS INTEGER) AS n_authors FROM corpus""")
def q_record_authors(spark, d):
    r = parsed_records(spark, d)
    return r.select("pmid", F.array_join("authors", "; ").alias("authors"), F.size("authors").alias("n_authors"))


@register("record_year", cte("corpus") + "SELECT pmid, year FROM corpus")
def q_record_year(spark, d):
    return parsed_records(spark, d).select("pmid", "year")


@register("record_doi", cte("corpus") + "SELECT pmid, doi FROM corpus")
def q_record_doi(spark, d):
    return parsed_records(spark, d).select("pmid", "doi")


@register("record_core", cte("corpus") + "SELECT pmid, title, journal FROM corpus")
def q_record_core(spark, d):
    return parsed_records(spark, d).select("pmid", "title", "journal")


@register("record_abstract", cte("corpus") + "SELECT pmid, abstract, CAST(length(abstract) AS INTEGER) AS n_chars FROM corpus")
def q_record_abstract(spark, d):
    return parsed_records(spark, d).select("pmid", "abstract", F.length("abstract").alias("n_chars"))


@register("record_mesh", cte("corpus") + """
SELECT pmid, array_to_string(mesh_major_topics, '; ') AS mesh_major_topics FROM corpus""")
def q_record_mesh(spark, d):
    return parsed_records(spark, d).select("pmid", F.array_join("mesh_major_topics", "; ").alias("mesh_major_topics"))


@register("build_query_text", cte("search_terms") + """
SELECT gene, '"' || gene || '"[Title/Abstract] AND "Colorectal Neoplasms"[MeSH Major Topic] AND hasabstract[text]' AS query
FROM search_terms""")
def q_build_query_text(spark, d):
    return A.search_terms(spark, d).select("gene", T.build_query("gene").alias("query"))


@register("embed_text_base", cte("corpus") + """
SELECT pmid, md5(title || chr(10) || chr(10) || abstract) AS text_md5, CAST(length(title || chr(10) || chr(10) || abstract) AS INTEGER) AS n_chars
FROM corpus""")
def q_embed_text_base(spark, d):
    """P12 over every record (text compared through md5 + length)."""
    t = A.corpus_records(spark, d).select("pmid", T.text_base().alias("t"))
    return t.select("pmid", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"))


_MESH_TEXT = """title || chr(10) || chr(10) || abstract ||
  CASE WHEN len(mesh_major_topics) > 0 THEN chr(10) || chr(10) || 'MeSH: ' || array_to_string(mesh_major_topics, '; ') ELSE '' END"""


@register("embed_text_mesh", cte("corpus") + f"""
SELECT pmid, md5({_MESH_TEXT}) AS text_md5, CAST(length({_MESH_TEXT}) AS INTEGER) AS n_chars FROM corpus""")
def q_embed_text_mesh(spark, d):
    t = A.corpus_records(spark, d).select("pmid", T.text_with_mesh().alias("t"))
    return t.select("pmid", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"))


@register("render_citation", cte("corpus") + """
SELECT pmid, md5('PMID: ' || pmid || ' | ' || coalesce(CAST(year AS VARCHAR), 'None') || ' | ' || journal
  || chr(10) || 'Authors: ' || array_to_string(authors[1:3], ', ') || CASE WHEN len(authors) > 3 THEN '...' ELSE '' END
  || chr(10) || chr(10) || 'Title: ' || title || chr(10) || chr(10) || 'Abstract:' || chr(10) || abstract) AS citation_md5
FROM corpus""")
def q_render_citation(spark, d):
    r = A.corpus_records(spark, d)
    return r.select("pmid", F.md5(T.render_citation()).alias("citation_md5"))


@register("corpus_search", cte("hits") + "SELECT gene, gene_ord, hit_ord, pmid FROM hits")
def q_corpus_search(spark, d):
    return hits(spark, d)


@register("phrase_search", cte("corpus", "phrases") + """
SELECT gene, gene_ord, CAST(hit_ord AS INTEGER) AS hit_ord, pmid FROM (
  SELECT s.gene, s.gene_ord, d.pmid, row_number() OVER (PARTITION BY s.gene ORDER BY d.year DESC NULLS LAST, d.pmid DESC) AS hit_ord
  FROM (SELECT pmid, year, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}]+'),
                                                              lambda t: length(t) > 0), ' ') || ' ' AS in_title,
               ' ' || array_to_string(list_filter(regexp_split_to_array(lower(abstract), '[^\\p{L}\\p{N}]+'),
                                                  lambda t: length(t) > 0), ' ') || ' ' AS in_abstract
        FROM corpus WHERE list_contains(mesh_major_topics, 'Colorectal Neoplasms') AND length(abstract) > 0) d
  JOIN phrases s ON contains(d.in_title, ' ' || s.gene || ' ') OR contains(d.in_abstract, ' ' || s.gene || ' ')) WHERE hit_ord <= 20""")
def q_phrase_search(spark, d):
    """S6 with whole benchmark items as phrases, however long."""
    return C.search_corpus(A.corpus_records(spark, d), A.phrases(spark, d))


@register("ordered_fetch", cte("flat") + "SELECT gene, hit_ord, pmid, title, year FROM flat")
def q_ordered_fetch(spark, d):
    return C.ordered_fetch(hits(spark, d), A.corpus_records(spark, d)).select("gene", "hit_ord", "pmid", "title", "year")


@register("flatten_hits", cte("flat") + """
SELECT gene, gene_ord, hit_ord, pmid, journal, doi FROM flat""")
def q_flatten_hits(spark, d):
    return _flat(spark, d).select("gene", "gene_ord", "hit_ord", "pmid", "journal", "doi")


@register("first_hits", cte("hits", "search_terms") + """
SELECT gene, pmid FROM hits WHERE hit_ord = 1 AND gene IN (SELECT gene FROM search_terms)""")
def q_first_hits(spark, d):
    return C.first_hits(hits(spark, d), A.search_terms(spark, d)).select("gene", "pmid")


@register("literature_gaps", cte("hits", "search_terms") + """
SELECT gene, gene_ord FROM search_terms WHERE gene NOT IN (SELECT gene FROM hits)""")
def q_literature_gaps(spark, d):
    return C.literature_gaps(A.search_terms(spark, d), hits(spark, d))


@register("retrieval_summary", cte("flat", "search_terms", extra="""
per AS (SELECT gene, count(*) AS n, count(doi) AS nd, min(year) AS y0, max(year) AS y1 FROM flat GROUP BY gene),
jc AS (SELECT gene, journal, row_number() OVER (PARTITION BY gene ORDER BY count(*) DESC, journal) AS r
       FROM flat GROUP BY gene, journal)""") + """
SELECT s.gene, s.gene_ord, coalesce(p.n, 0) AS n_abstracts, coalesce(p.nd, 0) AS with_doi,
       p.y0 AS year_min, p.y1 AS year_max, j.journal AS top_journal
FROM search_terms s LEFT JOIN per p USING (gene) LEFT JOIN (SELECT gene, journal FROM jc WHERE r = 1) j USING (gene)""")
def q_retrieval_summary(spark, d):
    return C.retrieval_summary(A.search_terms(spark, d), hits(spark, d), A.corpus_records(spark, d))


@register("dedup_records", cte("flat") + """
SELECT pmid, arg_min(gene, (gene_ord, hit_ord)) AS first_gene, arg_min(title, (gene_ord, hit_ord)) AS title,
       string_agg(gene, '; ' ORDER BY gene_ord, hit_ord) AS genes, CAST(count(*) AS INTEGER) AS n_genes
FROM flat GROUP BY pmid""")
def q_dedup_records(spark, d):
    r = C.dedup_records(_flat(spark, d))
    return r.select("pmid", F.col("gene").alias("first_gene"), "title", "genes", "n_genes")


@register("dedup_stats", cte("flat") + """
SELECT count(*) AS n_original, count(DISTINCT pmid) AS n_unique,
       (SELECT count(*) FROM (SELECT pmid FROM flat GROUP BY pmid HAVING count(DISTINCT gene) > 1)) AS n_multi_gene
FROM flat""")
def q_dedup_stats(spark, d):
    return C.dedup_stats(_flat(spark, d))


@register("record_merge", cte("corpus") + """
SELECT pmid, CASE WHEN journal = 'Journal of src1' THEN '[rev] ' || title ELSE title END AS title, year FROM corpus""")
def q_record_merge(spark, d):
    """All records as the cache, merged with a fresh batch (one journal,
    titles marked revised); the fresh batch wins on shared pmids."""
    old = r = A.corpus_records(spark, d)
    new = r.where(F.col("journal") == "Journal of src1").withColumn("title", F.concat(F.lit("[rev] "), "title"))
    return C.merge_records(old, new).select("pmid", "title", "year")


@register("record_cache_roundtrip", cte("corpus") + """
SELECT pmid, md5(title || '|' || abstract) AS text_md5, array_to_string(authors, '; ') AS authors, year, doi, journal,
       array_to_string(mesh_major_topics, '; ') AS mesh_major_topics FROM corpus""")
def q_record_cache_roundtrip(spark, d):
    """Save the records as a JSON-lines cache, load them back typed."""
    from helixframe.session import scratch_path
    path = scratch_path(spark, "record_cache")
    C.save_records(A.corpus_records(spark, d), path)
    back = C.load_records(spark, path)
    return back.select("pmid", F.md5(F.concat_ws("|", "title", "abstract")).alias("text_md5"),
                       F.array_join("authors", "; ").alias("authors"), "year", "doi", "journal",
                       F.array_join("mesh_major_topics", "; ").alias("mesh_major_topics"))


@register("corpus_from_xml_files", cte("corpus") + """
SELECT pmid, title, abstract, array_to_string(authors, '; ') AS authors, year, doi, journal,
       array_to_string(mesh_major_topics, '; ') AS mesh_major_topics FROM corpus""")
def q_corpus_from_xml_files(spark, d):
    """S5 file path: the corpus written as XML documents (one per partition) and read
    with the XML data source under the declared schema."""
    from helixframe.session import scratch_path
    path = scratch_path(spark, "corpus_xml")
    X.write_xml_documents(A.corpus_xml(spark, d), path)
    r = X.read_pubmed_xml(spark, path)
    return r.select("pmid", "title", "abstract", F.array_join("authors", "; ").alias("authors"), "year", "doi",
                    "journal", F.array_join("mesh_major_topics", "; ").alias("mesh_major_topics"))
