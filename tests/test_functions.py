"""Scalar column functions: string, map and record rules."""

import math

from pyspark.sql import functions as F

from helixframe.functions import text as T
from helixframe.operators import results as RS


def test_parse_attrs_rules(spark):
    df = spark.createDataFrame(
        [("organ;;left lung sample|kit name;; x |junk|a;;b;;c|a;;d",), (None,)], "s string")
    rows = df.select(T.parse_attrs("s").alias("m")).collect()
    assert rows[0].m == {"organ": "left lung sample", "kit name": "x", "a": "d"}
    assert rows[1].m == {}


def test_promote_attrs_names(spark):
    from helixframe.operators.reshape import promote_attrs
    df = spark.createDataFrame([("s1", "Source Name;;x|tissue;;y")], "id string, s string") \
        .select("id", T.parse_attrs("s").alias("attrs"))
    out = promote_attrs(df, "attrs").drop("attrs")
    assert set(out.columns) == {"id", "source_name", "tissue"}


def test_standardize_condition_order(spark):
    df = spark.createDataFrame([("Metastasized cancer",), ("normal-looking colonic tumor edge",), ("Primary",),
                                ("blood",), (None,)], "t string")
    got = [r[0] for r in df.select(T.standardize_condition("t")).collect()]
    assert got == ["metastasis", "normal", "tumor", "unknown", None]


def test_extract_patient_and_strip_version(spark):
    df = spark.createDataFrame([("AMC_12-1 RNA", "GENE77001234567.3"), ("other", "GENE77001234567")], "t string, g string")
    got = df.select(T.extract_patient("t").alias("p"), T.strip_version("g").alias("k")).collect()
    assert [r.p for r in got] == ["P12", None]
    assert [r.k for r in got] == ["GENE77001234567", "GENE77001234567"]


def test_gene_label_and_hit_label(spark):
    df = spark.createDataFrame([(None, "GENE77001234567.3", "1", 0.12345), ("QZX9", "x", "2", None)],
                               "symbol string, gene_id string, id string, distance double")
    got = df.select(T.gene_label("symbol", "gene_id").alias("l"),
                    T.hit_label("id", "symbol", F.coalesce("distance", F.lit(1.0))).alias("h")).collect()
    assert got[0].l == "1234567.3"[-15:] or got[0].l == "GENE77001234567.3"[-15:]
    assert got[1].l == "QZX9"
    assert got[0].h == "1 | ? | d=0.123"


def test_neg_log10_and_volcano(spark):
    df = spark.createDataFrame([(0.0, 2.0), (0.05, 3.0), (0.01, 1.0), (0.01, -1.5), (None, 5.0), (0.01, float("nan"))],
                               "padj double, log2_fold_change double")
    df = RS.nan_to_null(df)
    v = RS.volcano_points(df.withColumn("contrast", F.lit("c"))).orderBy("padj", "log2_fold_change").collect()
    assert len(v) == 5
    cats = {(r.padj, r.log2_fold_change): r.category for r in v}
    assert cats[(0.0, 2.0)] == "up" and math.isinf([r for r in v if r.padj == 0.0][0].neg_log10_padj)
    assert cats[(0.05, 3.0)] == "ns"          # padj < alpha is strict
    assert cats[(0.01, 1.0)] == "ns"          # |LFC| > 1 is strict
    assert cats[(0.01, -1.5)] == "down"
    assert cats[(0.01, None)] == "ns"         # NaN became NULL, not "up"


def test_render_citation_and_texts(spark):
    df = spark.createDataFrame([("1", 2020, "J", ["A", "B", "C", "D"], "T", "Abs", ["m1", "m2"]),
                                ("2", None, "J", ["A"], "T", "", [])],
                               "pmid string, year int, journal string, authors array<string>, title string, "
                               "abstract string, mesh_major_topics array<string>")
    r = df.select(T.render_citation().alias("c"), T.text_with_mesh().alias("m"), T.text_base().alias("b")).collect()
    assert r[0].c == "PMID: 1 | 2020 | J\nAuthors: A, B, C...\n\nTitle: T\n\nAbstract:\nAbs"
    assert r[1].c.startswith("PMID: 2 | None | J\nAuthors: A\n")
    assert r[0].m == "T\n\nAbs\n\nMeSH: m1; m2"
    assert r[1].m == r[1].b == "T\n\n"


def test_build_query(spark):
    df = spark.createDataFrame([("QZX9",)], "g string")
    q = df.select(T.build_query("g")).first()[0]
    assert q == '"QZX9"[Title/Abstract] AND "Colorectal Neoplasms"[MeSH Major Topic] AND hasabstract[text]'


def test_alignment_check_raises_on_missing_sample(spark):
    import pytest
    from helixframe.operators import reshape as R
    counts = spark.createDataFrame([("g", "s1", 1), ("g", "s2", 2)], "gene_id string, sample_id string, count long")
    samples = spark.createDataFrame([("s1",), ("s2",)], "sample_id string")
    qc = spark.createDataFrame([("s1",)], "sample_id string")
    al = R.check_alignment(counts, samples, qc)
    assert {r.sample_id: r.in_qc for r in al.collect()} == {"s1": True, "s2": False}
    with pytest.raises(ValueError):
        R.assert_aligned(al)


def test_gzip_tsv_counts_with_comments(spark, tmp_path):
    """Gzip TSV, '#' comment lines skipped, a mid-line '#' kept, wide -> long with zeros."""
    import gzip
    from helixframe.sources import tabular as TB
    p = tmp_path / "counts.tsv.gz"
    with gzip.open(p, "wt") as f:
        f.write("# exported counts\ngene_id\tS1\tS2\n# note\nG1.3\t5\t0\nG2\t7\t9\n")
    long = {(r.gene_id, r.sample_id): r["count"] for r in TB.read_counts(spark, str(p), sep="\t", comment="#").collect()}
    assert long == {("G1.3", "S1"): 5, ("G1.3", "S2"): 0, ("G2", "S1"): 7, ("G2", "S2"): 9}
    m = tmp_path / "meta.tsv"
    m.write_text("# header comment\nexternal_id\ttitle\nS1\tAMC_01 #run1\n")
    row = TB.read_tsv(spark, str(m)).first()
    assert row.title == "AMC_01 #run1"


def test_coverage_to_counts_half_even(spark):
    from helixframe.operators.reshape import coverage_to_counts
    cov = spark.createDataFrame([("g", "s", 2.5), ("g", "t", 3.5), ("g", "u", 7.0)],
                                "gene_id string, sample_id string, coverage double")
    qc = spark.createDataFrame([("s", 1.0), ("t", 1.0), ("u", 2.0)], "external_id string, avg_len double")
    got = {r.sample_id: r["count"] for r in coverage_to_counts(cov, qc).collect()}
    assert got == {"s": 2, "t": 4, "u": 4}   # half to even: 2.5 -> 2, 3.5 -> 4, 3.5 -> 4


def test_counts_with_a_quoted_header(spark, tmp_path):
    from helixframe.sources import tabular as TB
    p = tmp_path / "quoted.csv"
    p.write_text('"","SRR1","SRR 2"\n"G1",5,0\n"G2",7,9\n')
    got = {(r.gene_id, r.sample_id): r["count"] for r in TB.read_counts(spark, str(p)).collect()}
    assert got == {("G1", "SRR1"): 5, ("G1", "SRR 2"): 0, ("G2", "SRR1"): 7, ("G2", "SRR 2"): 9}


def test_phrases_do_not_cross_title_and_abstract(spark):
    from helixframe.operators.corpus import search_corpus
    corpus = spark.createDataFrame([("1", 2000, "About tumor", "necrosis in cells", ["Colorectal Neoplasms"]),
                                    ("2", 2001, "Tumor necrosis", "text", ["Colorectal Neoplasms"]),
                                    ("3", 2002, None, "of Tumor-necrosis type", ["Colorectal Neoplasms"]),
                                    ("4", 2003, "tumor necrosis", "x", ["Other"])],
                                   "pmid string, year int, title string, abstract string, mesh_major_topics array<string>")
    genes = spark.createDataFrame([("tumor necrosis", 0), ("cells", 1)], "gene string, gene_ord int")
    got = [(r.gene, r.hit_ord, r.pmid) for r in search_corpus(corpus, genes).orderBy("gene", "hit_ord").collect()]
    assert got == [("cells", 1, "1"), ("tumor necrosis", 1, "3"), ("tumor necrosis", 2, "2")]


def test_missing_checkpoint_folder_is_an_error_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from helixframe.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)
