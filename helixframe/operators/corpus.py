"""Literature operators over a citation-record table.

Records: pmid, title, abstract, authors, year, doi, journal,
mesh_major_topics. Gene query lists: (gene, gene_ord). Hits:
(gene, gene_ord, hit_ord, pmid), hit_ord 1-based within a gene.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions import text as T
from helixframe.operators.results import cache_misses
from helixframe.session import cut_lineage
from helixframe.sources import versioned
from helixframe.sources.xml_corpus import RECORD_SCHEMA


def search_corpus(corpus: DataFrame, genes: DataFrame, disease: str = T.DEFAULT_DISEASE,
                  max_results: int = 20) -> DataFrame:
    """S6 + F6: at most ``max_results`` hits per gene, newest first.

    A record matches a gene when the gene's word sequence (any length) occurs in the
    tokenised title or in the tokenised abstract (not across the two), the disease is one of its major topics,
    and the abstract is non-empty. A gene is cut into units: its word, or each pair of neighbouring words with its
    offset. A record's words and its pairs with their positions are equi-joined to the units; a
    gene of one unit is found by that alone, a longer phrase where all its units meet at one start (position less
    offset). No token array passes a shuffle. The
    per-gene cut is ``row_number() <= k``, which Spark plans with a
    partial WindowGroupLimit before the shuffle, so a very common word
    cannot pile all its matches onto one task. Order: year desc (missing
    last), then pmid desc. A gene without words has no hit; a record
    that is there twice is one hit, and texts that share an id are searched apart.
    """
    docs = corpus.where(F.array_contains("mesh_major_topics", F.lit(disease)) & (F.length("abstract") > 0))
    docs = docs.select("pmid", "year", F.xxhash64("title", "abstract").alias("rec"), *[F.coalesce(T.word_tokens(c), F.array()).alias(c) for c in ("title", "abstract")])
    # title, a gap, abstract: each word with the one after it, so that units are made row by row
    docs = docs.select("pmid", "year", "rec", F.size("title").alias("gap"), F.concat("title", F.array(F.lit(None).cast("string")), "abstract").alias("a"))
    docs = docs.withColumn("b", F.slice("a", 2, F.size("a")))
    w = docs.select("pmid", "year", "rec", "gap", F.posexplode(F.arrays_zip("a", "b")).alias("p", "w")).where(F.col("w.a").isNotNull())
    late = F.col("p") > F.col("gap")
    pair = F.when(F.col("w.b").isNotNull(), _unit(F.concat("w.a", F.lit(" "), "w.b"), late.cast("int"), F.col("p") - F.when(late, F.col("gap") + 1).otherwise(0)))
    cand = w.select("pmid", "year", "rec", F.explode(F.array(_unit(F.col("w.a"), -1, -1), pair)).alias("u"))
    q = genes.select("gene", "gene_ord", T.word_tokens("gene").alias("gtok")).where(F.size("gtok") > 0)
    one = F.size("gtok") == 1
    q = q.select("gene", "gene_ord", F.greatest(F.size("gtok") - 1, F.lit(1)).alias("units"),
                 F.explode(F.when(one, F.transform("gtok", lambda t: _unit(t, -1, 0))).otherwise(_pairs(F.col("gtok"), 0))).alias("q"))
    m = cand.join(q, F.col("u.unit") == F.col("q.unit"))
    # one unit: anywhere in the record; more: all of them from one start of one field
    spot = [F.when(F.col("units") > 1, c).otherwise(F.lit(0)).alias(n)
            for n, c in (("field", F.col("u.field")), ("start", F.col("u.pos") - F.col("q.pos")))]
    m = m.select("gene", "gene_ord", "pmid", "year", "rec", "units", *spot, F.col("q.pos").alias("off"))
    short = F.col("units") == 1
    m = m.groupBy("gene", "gene_ord", "pmid", "year", "rec", "units", "field", "start") \
        .agg(F.collect_set(F.when(~short, F.col("off"))).alias("offs")) \
        .where(short | (F.size("offs") == F.col("units")))
    m = m.select("gene", "gene_ord", "pmid", "year").distinct()
    w = Window.partitionBy("gene").orderBy(F.col("year").desc_nulls_last(), F.col("pmid").desc())
    return (m.withColumn("hit_ord", F.row_number().over(w)).where(F.col("hit_ord") <= max_results)
            .select("gene", "gene_ord", "hit_ord", "pmid"))


def _unit(text: Column, field, pos) -> Column:
    pos, field = (F.lit(x) if isinstance(x, int) else x for x in (pos, field))
    return F.struct(text.alias("unit"), field.alias("field"), pos.cast("int").alias("pos"))


def _pairs(tokens: Column, field: int) -> Column:
    """Neighbouring words as units with their position (words hold no space, so a pair is never a word)."""
    n = F.size(tokens) - 1
    return F.zip_with(F.slice(tokens, 1, F.greatest(n, F.lit(0))), F.transform(F.slice(tokens, 2, F.greatest(n, F.lit(0))),
                      lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
                      lambda a, b: _unit(F.concat(a, F.lit(" "), b["t"]), field, b["i"]))


def ordered_fetch(hits: DataFrame, records: DataFrame) -> DataFrame:
    """Records in search order (gene_ord, hit_ord); hits without a record are dropped."""
    return hits.join(records, "pmid", "inner")


def flatten_hits(hits: DataFrame, records: DataFrame) -> DataFrame:
    """U4: one row per (gene, record), gene kept: the flat list the embedder consumes."""
    return ordered_fetch(hits, records)


def first_hits(hits: DataFrame, genes: DataFrame) -> DataFrame:
    """First hit of each requested gene; genes without hits give nothing."""
    return hits.where(F.col("hit_ord") == 1).join(genes.select("gene"), "gene", "left_semi")


def literature_gaps(genes: DataFrame, hits: DataFrame) -> DataFrame:
    """Requested genes with no hit at all."""
    return genes.join(hits.select("gene").distinct(), "gene", "left_anti")


def retrieval_summary(genes: DataFrame, hits: DataFrame, records: DataFrame) -> DataFrame:
    """A4: per gene: n abstracts, n with DOI, min / max year (missing skipped) and
    the most frequent journal (ties by name); genes without hits give 0 and NULLs."""
    h = ordered_fetch(hits, records)
    per = h.groupBy("gene").agg(
        F.count(F.lit(1)).alias("n_abstracts"), F.count("doi").alias("with_doi"),
        F.min("year").alias("year_min"), F.max("year").alias("year_max"))
    jc = h.groupBy("gene", "journal").agg(F.count(F.lit(1)).alias("n"))
    top = jc.withColumn("r", F.row_number().over(
        Window.partitionBy("gene").orderBy(F.col("n").desc(), F.col("journal")))).where("r = 1") \
        .select("gene", F.col("journal").alias("top_journal"))
    out = genes.select("gene", "gene_ord").join(per, "gene", "left").join(top, "gene", "left")
    return out.select("gene", "gene_ord", F.coalesce("n_abstracts", F.lit(0)).alias("n_abstracts"),
                      F.coalesce("with_doi", F.lit(0)).alias("with_doi"), "year_min", "year_max", "top_journal")


def dedup_records(flat: DataFrame) -> DataFrame:
    """One row per pmid; the record of its first occurrence in flat order
    (gene_ord, hit_ord) and ``genes`` = its genes in first-seen order joined by '; '.

    A paper hit by many genes groups at most one row per gene, so the
    group size is bounded by the gene list.
    """
    cols = [c for c in flat.columns if c not in ("pmid",)]
    first = F.min_by(F.struct(*cols), F.struct("gene_ord", "hit_ord"))
    gl = F.array_sort(F.collect_list(F.struct("gene_ord", "hit_ord", "gene")))
    g = flat.groupBy("pmid").agg(first.alias("r"), F.transform(gl, lambda x: x["gene"]).alias("gene_list"))
    return g.select("pmid", "r.*", F.array_join("gene_list", "; ").alias("genes"), F.size("gene_list").alias("n_genes"))


def dedup_stats(flat: DataFrame) -> DataFrame:
    """Original rows, unique pmids, papers hit by more than one gene."""
    per = flat.groupBy("pmid").agg(F.countDistinct("gene").alias("k"), F.count(F.lit(1)).alias("rows"))
    return per.agg(F.sum("rows").alias("n_original"), F.count(F.lit(1)).alias("n_unique"),
                   F.count_if(F.col("k") > 1).alias("n_multi_gene"))


def merge_records(old: DataFrame, new: DataFrame, key: str = "pmid") -> DataFrame:
    """Keyed union of two record sets; the new side wins."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def save_records(records: DataFrame, path: str, fmt: str = "json") -> None:
    """Persist the record cache (JSON lines by default, keyed by pmid) as its next version; ``records`` may
    have been merged from the version before."""
    versioned.save(records, path, fmt)


def load_records(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Load the record cache; one never saved gives an empty typed frame."""
    return versioned.load(spark, path, RECORD_SCHEMA, fmt)


def cached_fetch(spark: SparkSession, hits: DataFrame, path: str, fetch: Callable[[DataFrame], DataFrame], fmt: str = "json") -> DataFrame:
    """Records of ``hits`` in search order, through the cache: load it, fetch only the pmids it lacks (``fetch``
    takes a one-column frame of them), merge, save, and join. Nothing missing: nothing fetched or saved."""
    cache = load_records(spark, path, fmt)
    missing = cut_lineage(cache_misses(hits, cache, "pmid"))
    if missing.limit(1).count():
        save_records(merge_records(cache, fetch(missing).select(*cache.columns)), path, fmt)
        cache = load_records(spark, path, fmt)
    return ordered_fetch(hits, cache)
