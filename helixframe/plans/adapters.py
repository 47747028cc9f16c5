"""Views over the input tables in the shapes the operators expect.

The input tables are a retail star schema plus text and vector tables;
these functions derive expression-study shapes from them so every
registered query reads the given data and its work grows with it:

* genes   = parts (``ENSG<partkey 11 digits>.<p_size>``), so the gene axis
            grows with the scale factor;
* samples = customer region x line return flag (patient x condition);
* counts  = sum of line quantities per (part, region, flag);
* corpus  = ``documents`` rendered as citation records (and as XML);
* vectors = ``embeddings`` rows, label = gene.

Every adapter has a SQL twin in ``helixframe.plans.oracle`` built from the
same rules, used as the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.sources.tables import read_table

# Fixed values of the adapters (data-shaping rules; the oracle SQL repeats them).
TISSUE_TEXT = {"A": "Primary Tumor", "N": "Normal Mucosa", "R": "Liver metastasis"}
READ_LENGTH = 76           # nominal read length turning quantities into coverage sums
QC_BASE_LENGTH = 50.5      # average mapped length = 50.5 + 2 * region
UNMAPPED_EVERY = 7         # every 7th part key has no symbol
DISEASE = "Colorectal Neoplasms"


def gene_id_col(partkey, size) -> "F.Column":
    return F.concat(F.lit("ENSG"), F.lpad(partkey.cast("string"), 11, "0"), F.lit("."), size.cast("string"))


def sample_id_col(region, flag) -> "F.Column":
    return F.concat(F.lit("P"), F.lpad(region.cast("string"), 2, "0"), F.lit("_"), flag)


def count_cells(spark: SparkSession, d: str) -> DataFrame:
    """Per (part, region, flag): summed quantity and coverage.

    lineitem x orders is the one large join (shuffle or bucketed on the
    order key); customer -> region goes through the 25-row nation table,
    broadcast by construction. Aggregation happens before the part join.
    """
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_returnflag", "l_quantity")
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, d, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, d, "nation", "n_nationkey", "n_regionkey")
    cust = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", "n_regionkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(cust, F.col("o_custkey") == cust.c_custkey)
            .groupBy("l_partkey", "n_regionkey", "l_returnflag")
            .agg(F.sum("l_quantity").alias("qty")))


def study_cells(spark: SparkSession, d: str) -> DataFrame:
    """The aggregated (part, region, flag) cells, written once to the shared
    checkpoint folder: every later action of a query (sample count, size
    checks, size factors, fits) reads this small table instead of re-running
    the lineitem x orders x customer join."""
    from helixframe.session import cut_lineage
    return cut_lineage(count_cells(spark, d))


def counts_long(spark: SparkSession, d: str, cells: DataFrame | None = None) -> DataFrame:
    """(gene_id, sample_id, count bigint); cells with no line are absent (sparse)."""
    cells = count_cells(spark, d) if cells is None else cells
    p = read_table(spark, d, "part", "p_partkey", "p_size")
    return (cells.join(p, cells.l_partkey == p.p_partkey)
            .select(gene_id_col(F.col("p_partkey"), F.col("p_size")).alias("gene_id"),
                    sample_id_col(F.col("n_regionkey"), F.col("l_returnflag")).alias("sample_id"),
                    F.col("qty").cast("bigint").alias("count")))


def coverage_long(spark: SparkSession, d: str, cells: DataFrame | None = None) -> DataFrame:
    """(gene_id, sample_id, coverage double): base coverage sums, as in a recount table."""
    cells = count_cells(spark, d) if cells is None else cells
    p = read_table(spark, d, "part", "p_partkey", "p_size")
    return (cells.join(p, cells.l_partkey == p.p_partkey)
            .select(gene_id_col(F.col("p_partkey"), F.col("p_size")).alias("gene_id"),
                    sample_id_col(F.col("n_regionkey"), F.col("l_returnflag")).alias("sample_id"),
                    (F.col("qty") * F.lit(float(READ_LENGTH))).alias("coverage")))


def study_metadata(spark: SparkSession, d: str, counts: DataFrame | None = None) -> DataFrame:
    """Raw study metadata, one row per sample present in the counts:
    (external_id, sample_attributes, experiment_title, region)."""
    cells = count_cells(spark, d) if counts is None else counts
    s = cells.select("n_regionkey", "l_returnflag").distinct()
    r = read_table(spark, d, "region", "r_regionkey", "r_name")
    tissue = F.when(F.col("l_returnflag") == "A", F.lit(TISSUE_TEXT["A"])) \
        .when(F.col("l_returnflag") == "N", F.lit(TISSUE_TEXT["N"])) \
        .when(F.col("l_returnflag") == "R", F.lit(TISSUE_TEXT["R"])) \
        .otherwise(F.lit("blood"))
    reg = F.col("n_regionkey").cast("string")
    attrs = F.concat(F.lit("tissue;;"), tissue, F.lit("|patient id;; "), reg,
                     F.lit(" |junk field|lot;;"), F.col("r_name"), F.lit(";;x|lot;;"), F.col("l_returnflag"))
    title = F.concat(F.lit("AMC_"), F.lpad(reg, 2, "0"), F.lit("-"), F.col("l_returnflag"), F.lit(" RNA-seq"))
    return (s.join(F.broadcast(r), s.n_regionkey == r.r_regionkey)
            .select(sample_id_col(F.col("n_regionkey"), F.col("l_returnflag")).alias("external_id"),
                    attrs.alias("sample_attributes"), title.alias("experiment_title"),
                    F.col("n_regionkey").alias("region")))


def qc_table(spark: SparkSession, d: str, counts: DataFrame | None = None) -> DataFrame:
    """(external_id, avg_len): per-sample average mapped read length."""
    cells = count_cells(spark, d) if counts is None else counts
    s = cells.select("n_regionkey", "l_returnflag").distinct()
    return s.select(sample_id_col(F.col("n_regionkey"), F.col("l_returnflag")).alias("external_id"),
                    (F.lit(QC_BASE_LENGTH) + F.col("n_regionkey") * 2).cast("double").alias("avg_len"))


def symbol_hits(spark: SparkSession, d: str) -> DataFrame:
    """Raw id -> symbol service rows (gene_id unversioned, symbol, hit_ord).

    Duplicate hits exist for parts with size > 40 (second hit = brand), and
    every 7th key is reported as unmapped (NULL symbol).
    """
    p = read_table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size")
    gid = F.concat(F.lit("ENSG"), F.lpad(F.col("p_partkey").cast("string"), 11, "0"))
    sym = F.when(F.col("p_partkey") % UNMAPPED_EVERY == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.upper(F.regexp_replace("p_name", " ", "")), F.col("p_partkey").cast("string")))
    first = p.select(gid.alias("gene_id"), sym.alias("symbol"), F.lit(1).alias("hit_ord"), F.col("p_size").alias("size"))
    second = p.where(F.col("p_size") > 40).select(
        gid.alias("gene_id"), F.regexp_replace("p_brand", "#", "").alias("symbol"), F.lit(2).alias("hit_ord"),
        F.col("p_size").alias("size"))
    return first.unionByName(second)


def gene_sets(spark: SparkSession, d: str) -> DataFrame:
    """(term, symbol): one set per part type and one per size band (overlapping)."""
    p = read_table(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size")
    sym = F.concat(F.upper(F.regexp_replace("p_name", " ", "")), F.col("p_partkey").cast("string"))
    mapped = p.where(F.col("p_partkey") % UNMAPPED_EVERY != 0)
    by_type = mapped.select(F.concat(F.lit("TYPE_"), F.col("p_type")).alias("term"), sym.alias("symbol"))
    by_size = mapped.select(F.concat(F.lit("SIZE_"), F.lpad((F.col("p_size") / 10).cast("int").cast("string"), 2, "0"))
                            .alias("term"), sym.alias("symbol"))
    return by_type.unionByName(by_size)


def de_results_raw(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic DE-result table for two models ('single', 'blocked').

    Columns: contrast, gene_id, base_mean, log2_fold_change, lfc_se, stat,
    pvalue, padj. Includes NULL LFC, NULL p, p = 0, padj exactly 0.05,
    LFC exactly +-1 and ties, so every trap of the result operators shows.
    """
    p = read_table(spark, d, "part", "p_partkey", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    gid = gene_id_col(k, F.col("p_size"))
    lfc = F.when(F.col("p_size") == 1, F.lit(None).cast("double")) \
        .otherwise(((k * 37) % 81 - 40).cast("double") / F.lit(10.0))
    se = F.lit(0.1) + (k % 10).cast("double") / F.lit(10.0)

    def model(name: str, mult: int, mod: int, shift: float) -> DataFrame:
        x = ((k * mult) % mod).cast("double") / F.lit(float(mod))
        pv = F.when(F.col("p_size") == 2, F.lit(None).cast("double")).otherwise(x * x * x)
        padj = F.when(pv.isNull(), F.lit(None).cast("double")) \
            .when(k % 50 == 7, F.lit(0.05)).otherwise(F.least(F.lit(1.0), pv * F.lit(3.0)))
        l = lfc + F.lit(shift)
        return p.select(F.lit(name).alias("contrast"), gid.alias("gene_id"),
                        F.col("p_retailprice").alias("base_mean"), l.alias("log2_fold_change"),
                        se.alias("lfc_se"), (l / se).alias("stat"), pv.alias("pvalue"), padj.alias("padj"))

    return model("single", 7919, 997, 0.0).unionByName(model("blocked", 6007, 991, 0.5))


# ---------------------------------------------------------------- corpus

def _doc_parts(docs: DataFrame) -> DataFrame:
    nl = F.instr("text", "\n")
    return docs.select(
        F.col("doc_id"), F.col("lang"), F.col("source"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(nl > 0, F.substr(F.col("text"), nl + 1)).otherwise(F.lit("")).alias("abstract"))


def corpus_records(spark: SparkSession, d: str) -> DataFrame:
    """Citation records straight from ``documents`` (the expected S5 output).

    pmid = doc_id; title = first line; abstract = the rest ('' if none);
    authors, year, doi, journal and MeSH follow from doc_id, lang, source.
    """
    docs = read_table(spark, d, "documents", "doc_id", "text", "lang", "source")
    p = _doc_parts(docs)
    k = F.col("doc_id")
    authors = F.filter(F.array(
        F.concat(F.lit("L"), F.col("lang"), F.lit(" AB")),
        F.when(k % 3 == 0, F.concat(F.lit("S"), F.col("source")))
         .otherwise(F.concat(F.lit("S"), F.col("source"), F.lit(" C"))),
        F.when(k % 5 == 0, F.concat(F.col("source"), F.lit(" Consortium"))),
        F.when(k % 7 == 0, F.lit("Doe J")),
    ), lambda x: x.isNotNull())
    year = F.when(k % 10 != 0, F.lit(1990) + k % 30).when(k % 20 == 0, F.lit(2024)).cast("int")
    doi = F.when(k % 4 != 0, F.concat(F.lit("10.5555/d."), k.cast("string")))
    mesh = F.filter(F.array(
        F.when(F.col("lang") == "en", F.lit(DISEASE)),
        F.concat(F.lit("Language "), F.upper("lang")),
        F.when(k % 3 == 0, F.lit("Humans")),
    ), lambda x: x.isNotNull())
    return p.select(k.cast("string").alias("pmid"), "title", "abstract", authors.alias("authors"),
                    year.alias("year"), doi.alias("doi"),
                    F.concat(F.lit("Journal of "), F.col("source")).alias("journal"),
                    mesh.alias("mesh_major_topics"))


def _esc(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def corpus_xml(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, xml): one ``PubmedArticle`` element per document.

    Carries the traps of the real format: a ``MedlineDate`` instead of a
    year, DOI only in ``ELocationID`` / references, two DOIs, an author
    without a name, a qualifier-only major flag, inline markup and entities.
    """
    docs = read_table(spark, d, "documents", "doc_id", "text", "lang", "source")
    p = _doc_parts(docs)
    k = F.col("doc_id")
    ks = k.cast("string")

    def el(tag, body, attrs=""):
        return F.concat(F.lit(f"<{tag}{attrs}>"), body, F.lit(f"</{tag}>"))

    author = lambda last, ini: el("Author", F.concat(
        F.coalesce(el("LastName", last), F.lit("")) if last is not None else F.lit(""),
        F.coalesce(el("Initials", ini), F.lit("")) if ini is not None else F.lit("")), ' ValidYN="Y"')
    a1 = author(F.concat(F.lit("L"), F.col("lang")), F.lit("AB"))
    a2 = author(F.concat(F.lit("S"), F.col("source")), F.when(k % 3 != 0, F.lit("C")))
    a3 = F.when(k % 5 == 0, el("Author", el("CollectiveName", F.concat(F.col("source"), F.lit(" Consortium")))))
    a4 = F.when(k % 2 == 0, el("Author", el("Initials", F.lit("Z"))))
    a5 = F.when(k % 7 == 0, author(F.lit("Doe"), F.lit("J")))
    authors = el("AuthorList", F.concat_ws("", a1, a2, a3, a4, a5))
    pubdate = F.when(k % 10 != 0, el("Year", (F.lit(1990) + k % 30).cast("string"))) \
        .when(k % 20 == 0, el("MedlineDate", F.lit("2024 Spring"))) \
        .otherwise(el("MedlineDate", F.lit("Winter 2000")))
    journal = el("Journal", F.concat(el("JournalIssue", el("PubDate", pubdate)),
                                     el("Title", F.concat(F.lit("Journal of "), F.col("source")))))
    title_xml = _esc(F.col("title"))
    # mark the first word up with <i>: the reader must keep the inner text
    title_xml = F.regexp_replace(title_xml, r"^(\p{L}+)", "<i>$1</i>")
    abstract = F.when(F.length("abstract") > 0,
                      el("Abstract", el("AbstractText", _esc(F.col("abstract"))))).otherwise(F.lit(""))
    eloc = el("ELocationID", F.concat(F.lit("10.0000/eloc."), ks), ' EIdType="doi" ValidYN="Y"')
    article = el("Article", F.concat(journal, el("ArticleTitle", title_xml), eloc, abstract, authors))
    mh = lambda name, flag, qual="": el("MeshHeading", F.concat(
        el("DescriptorName", name, f' MajorTopicYN="{flag}"') if isinstance(flag, str)
        else F.concat(F.lit('<DescriptorName MajorTopicYN="'), flag, F.lit('">'), name, F.lit("</DescriptorName>")),
        F.lit(qual)))
    mesh = el("MeshHeadingList", F.concat_ws(
        "",
        mh(F.lit(DISEASE), F.when(F.col("lang") == "en", F.lit("Y")).otherwise(F.lit("N"))),
        mh(F.concat(F.lit("Language "), F.upper("lang")), "Y"),
        mh(F.concat(F.lit("Source "), F.col("source")), "N",
           '<QualifierName MajorTopicYN="Y">genetics</QualifierName>'),
        F.when(k % 3 == 0, mh(F.lit("Humans"), "Y"))))
    medline = el("MedlineCitation", F.concat(el("PMID", ks, ' Version="1"'),
                                             el("DateCompleted", el("Year", F.lit("1999"))), article, mesh))
    ids = F.concat_ws(
        "",
        el("ArticleId", ks, ' IdType="pubmed"'),
        F.when(k % 4 != 0, el("ArticleId", F.concat(F.lit("10.5555/d."), ks), ' IdType="doi"')),
        F.when((k % 8 == 1), el("ArticleId", F.concat(F.lit("10.9999/alt."), ks), ' IdType="doi"')))
    refs = el("ReferenceList", el("Reference", el("ArticleIdList", el(
        "ArticleId", F.concat(F.lit("10.7777/ref."), ks), ' IdType="doi"'))))
    pubmed = el("PubmedData", F.concat(el("ArticleIdList", ids), refs))
    return p.select(k.alias("doc_id"), el("PubmedArticle", F.concat(medline, pubmed)).alias("xml"))


def damaged_xml(spark: SparkSession, d: str) -> DataFrame:
    """:func:`corpus_xml` with every 11th article cut off and every 13th without its PMID."""
    x = corpus_xml(spark, d)
    k = F.col("doc_id")
    cut = F.expr("substring(xml, 1, length(xml) div 2)")
    return x.select("doc_id", F.when(k % 11 == 0, cut).when(k % 13 == 0, F.regexp_replace("xml", "<PMID [^>]*>[^<]*</PMID>", ""))
                    .otherwise(F.col("xml")).alias("xml"))


def search_terms(spark: SparkSession, d: str) -> DataFrame:
    """Query genes for corpus search: the first word and the first two words of each benchmark
    item, lower-cased (gene, gene_ord); gene_ord follows the first item id using the term (one word before
    two), an order key that needs no global ranking window."""
    b = read_table(spark, d, "benchmark", "item_id", "text")
    low = F.lower("text")
    terms = F.array(F.regexp_extract(low, r"^([\p{L}\p{N}]+)", 1), F.regexp_extract(low, r"^([\p{L}\p{N}]+ [\p{L}\p{N}]+)", 1))
    w = b.select(F.posexplode(terms).alias("words", "gene"), "item_id").where(F.length("gene") > 0)
    return w.groupBy("gene").agg(F.min(F.col("item_id") * 2 + F.col("words")).alias("gene_ord"))


def phrases(spark: SparkSession, d: str) -> DataFrame:
    """All words of every benchmark item as one search phrase (gene, gene_ord); equal phrases once, by first item."""
    from helixframe.functions import text as T
    b = read_table(spark, d, "benchmark", "item_id", "text")
    p = b.select(F.array_join(T.word_tokens("text"), " ").alias("gene"), "item_id").where(F.length("gene") > 0)
    return p.groupBy("gene").agg(F.min("item_id").alias("gene_ord"))


def vector_rows(spark: SparkSession, d: str) -> DataFrame:
    """(id, gene, embedding array<float>) from ``embeddings`` (label = gene)."""
    e = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    return e.select(F.col("vec_id").cast("string").alias("id"),
                    F.concat(F.lit("G"), F.col("label").cast("string")).alias("gene"),
                    F.col("embedding"))


def samples(spark: SparkSession, d: str, counts: DataFrame | None = None) -> DataFrame:  # counts = cells
    """Design table (sample_id, sample_idx, patient, condition) parsed from the
    study metadata with P3 (attributes), P5 (condition) and P6 (patient)."""
    from helixframe.functions import text as T
    from helixframe.operators.reshape import index_samples
    meta = study_metadata(spark, d, counts)
    attrs = T.parse_attrs("sample_attributes")
    s = meta.select(F.col("external_id").alias("sample_id"),
                    T.extract_patient("experiment_title").alias("patient"),
                    T.standardize_condition(attrs.getItem("tissue")).alias("condition"))
    return index_samples(s).select("sample_id", "sample_idx", "patient", "condition")
