"""Registered queries over the count table, the study metadata and the design.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Doubles are rounded to 6 places on both sides so the oracle compare is exact.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import text as T
from helixframe.operators import normalize as N
from helixframe.operators import reshape as R
from helixframe.plans import adapters as A
from helixframe.plans.oracle import cte

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def _n_samples(counts):
    return counts.select("sample_id").distinct().count()


def _counts(spark, d):
    """Long counts over the checkpointed cells (one join per query)."""
    return A.counts_long(spark, d, A.study_cells(spark, d))


# ------------------------------------------------------------- D1 / D2

@register("size_factors", cte("counts_long", extra="""
pos AS (SELECT gene_id, sample_id, ln(count) AS lv FROM counts_long WHERE count > 0),
lgm AS (SELECT gene_id, avg(lv) AS lgm FROM pos GROUP BY gene_id
        HAVING count(*) = (SELECT count(DISTINCT sample_id) FROM counts_long))""") + """
SELECT sample_id, round(exp(quantile_cont(lv - lgm, 0.5)), 6) AS size_factor
FROM pos JOIN lgm USING (gene_id) GROUP BY sample_id""")
def q_size_factors(spark, d):
    cells = A.study_cells(spark, d)
    c = A.counts_long(spark, d, cells)
    sf = N.size_factors(c, _n_samples(c))
    return sf.select("sample_id", F.round("size_factor", 6).alias("size_factor"))


_SF_SQL = """
pos AS (SELECT gene_id, sample_id, ln(count) AS lv FROM counts_long WHERE count > 0),
lgm AS (SELECT gene_id, avg(lv) AS lgm FROM pos GROUP BY gene_id
        HAVING count(*) = (SELECT count(DISTINCT sample_id) FROM counts_long)),
sf AS (SELECT sample_id, exp(quantile_cont(lv - lgm, 0.5)) AS size_factor FROM pos JOIN lgm USING (gene_id) GROUP BY sample_id),
ns AS (SELECT CAST(count(DISTINCT sample_id) AS DOUBLE) AS n FROM counts_long)"""


@register("base_mean", cte("counts_long", extra=_SF_SQL) + """
SELECT gene_id, round(sum(count / size_factor) / (SELECT n FROM ns), 6) AS base_mean
FROM counts_long JOIN sf USING (sample_id) GROUP BY gene_id""")
def q_base_mean(spark, d):
    cells = A.study_cells(spark, d)
    c = A.counts_long(spark, d, cells)
    n = _n_samples(c)
    sf = N.size_factors(c, n)
    return N.base_mean(c, sf, n).select("gene_id", F.round("base_mean", 6).alias("base_mean"))


@register("group_mean_ratio", cte("counts_long", "samples", extra=_SF_SQL + """,
lv AS (SELECT condition, count(*) AS n_level FROM samples GROUP BY condition),
gm AS (SELECT c.gene_id, s.condition, sum(c.count / f.size_factor) AS sum_norm
       FROM counts_long c JOIN sf f USING (sample_id) JOIN samples s USING (sample_id) GROUP BY ALL),
m AS (SELECT gm.gene_id, gm.condition, sum_norm / n_level AS mean_norm FROM gm JOIN lv USING (condition)),
keep AS (SELECT gene_id FROM counts_long GROUP BY gene_id HAVING sum(count) >= 10)""") + """
SELECT t.gene_id, round(log2((t.mean_norm + 0.5) / (coalesce(n.mean_norm, 0) + 0.5)), 6) AS log2_ratio
FROM m t LEFT JOIN m n ON t.gene_id = n.gene_id AND n.condition = 'normal'
WHERE t.condition = 'tumor' AND t.gene_id IN (SELECT gene_id FROM keep)""")
def q_group_mean_ratio(spark, d):
    """Minimum slice: F2 -> D1 -> D2 -> log2 ratio of tumor / normal mean normalised counts."""
    cells = A.study_cells(spark, d)
    c = A.counts_long(spark, d, cells)
    n = _n_samples(c)
    s = A.samples(spark, d, cells)
    kept = R.keep_genes(c, 10)
    sf = N.size_factors(c, n)
    gm = N.group_means(kept, sf, s, "condition")
    t = gm.where(F.col("condition") == "tumor").select("gene_id", F.col("mean_norm").alias("t"))
    nn = gm.where(F.col("condition") == "normal").select("gene_id", F.col("mean_norm").alias("n"))
    return t.join(nn, "gene_id", "left").select(
        "gene_id", F.round(F.log2((F.col("t") + 0.5) / (F.coalesce("n", F.lit(0.0)) + 0.5)), 6).alias("log2_ratio"))


# ------------------------------------------------------------- A1 / F2 / P1 / P2

@register("gene_totals", cte("counts_long") + """
SELECT gene_id, CAST(sum(count) AS BIGINT) AS total FROM counts_long GROUP BY gene_id""")
def q_gene_totals(spark, d):
    return R.gene_totals(A.counts_long(spark, d))


@register("low_count_filter", cte("counts_long") + """
SELECT gene_id, sample_id, count FROM counts_long
WHERE gene_id IN (SELECT gene_id FROM counts_long GROUP BY gene_id HAVING sum(count) >= 10)""")
def q_low_count_filter(spark, d):
    return R.keep_genes(A.counts_long(spark, d), 10)


@register("counts_unpivot", cte("counts_long") + """
SELECT g.gene_id, s.sample_id, coalesce(c.count, 0) AS count
FROM (SELECT DISTINCT gene_id FROM counts_long) g
JOIN (SELECT DISTINCT sample_id FROM counts_long) s ON TRUE
LEFT JOIN counts_long c ON c.gene_id = g.gene_id AND c.sample_id = s.sample_id""")
def q_counts_unpivot(spark, d):
    """P1 both ways: sparse long -> wide (0-filled, explicit level list) -> long."""
    c = _counts(spark, d)
    levels = sorted(r[0] for r in c.select("sample_id").distinct().collect())
    wide = R.to_wide(c, levels)
    return R.to_long(wide).select("gene_id", "sample_id", F.col("count").cast("bigint").alias("count"))


@register("coverage_to_counts", cte("coverage_long", "qc") + """
SELECT c.gene_id, c.sample_id, CAST(round_even(c.coverage / q.avg_len, 0) AS BIGINT) AS count
FROM coverage_long c JOIN qc q ON c.sample_id = q.external_id""")
def q_coverage_to_counts(spark, d):
    cells = A.study_cells(spark, d)
    return R.coverage_to_counts(A.coverage_long(spark, d, cells), A.qc_table(spark, d, cells)).select("gene_id", "sample_id", "count")


@register("matrix_stats", cte("counts_long", "qc") + """
SELECT * FROM (
  SELECT 'n_samples' AS stat, CAST(count(DISTINCT sample_id) AS DOUBLE) AS value FROM counts_long
  UNION ALL SELECT 'n_genes', CAST(count(DISTINCT gene_id) AS DOUBLE) FROM counts_long
  UNION ALL SELECT 'max_count', CAST(max(count) AS DOUBLE) FROM counts_long
  UNION ALL SELECT 'min_len', min(avg_len) FROM qc
  UNION ALL SELECT 'max_len', max(avg_len) FROM qc)""")
def q_matrix_stats(spark, d):
    cells = A.study_cells(spark, d)
    return R.matrix_stats(A.counts_long(spark, d, cells), A.qc_table(spark, d, cells))


# ------------------------------------------------------------- metadata P3-P6, W6, A2, A3, F1, J1

@register("parse_attributes", cte("study_metadata") + """
SELECT external_id, 'tissue' AS key,
       trim(split_part(split_part(sample_attributes, '|', 1), ';;', 2)) AS value FROM study_metadata
UNION ALL SELECT external_id, 'patient id', trim(split_part(split_part(sample_attributes, '|', 2), ';;', 2)) FROM study_metadata
UNION ALL SELECT external_id, 'lot', trim(split_part(split_part(sample_attributes, '|', 5), ';;', 2)) FROM study_metadata""")
def q_parse_attributes(spark, d):
    """P3 on the metadata strings, exploded to (external_id, key, value)."""
    m = A.study_metadata(spark, d)
    return m.select("external_id", F.explode(T.parse_attrs("sample_attributes")).alias("key", "value"))


@register("attributes_to_columns", cte("study_metadata") + """
SELECT external_id,
       trim(split_part(split_part(sample_attributes, '|', 1), ';;', 2)) AS tissue,
       trim(split_part(split_part(sample_attributes, '|', 2), ';;', 2)) AS patient_id,
       trim(split_part(split_part(sample_attributes, '|', 5), ';;', 2)) AS lot
FROM study_metadata""")
def q_attributes_to_columns(spark, d):
    m = A.study_metadata(spark, d).select("external_id", T.parse_attrs("sample_attributes").alias("attrs"))
    return R.promote_attrs(m, "attrs").drop("attrs")


@register("standardize_condition", cte("samples") + """
SELECT sample_id, condition FROM samples""")
def q_standardize_condition(spark, d):
    return A.samples(spark, d).select("sample_id", "condition")


@register("extract_patient", cte("study_metadata") + """
SELECT external_id, 'P' || nullif(regexp_extract(experiment_title, 'AMC_(\\d+)', 1), '') AS patient
FROM study_metadata""")
def q_extract_patient(spark, d):
    m = A.study_metadata(spark, d)
    return m.select("external_id", T.extract_patient("experiment_title").alias("patient"))


@register("sample_index", cte("samples") + """
SELECT sample_id, sample_idx FROM samples""")
def q_sample_index(spark, d):
    return A.samples(spark, d).select("sample_id", "sample_idx")


@register("condition_counts", cte("samples") + """
SELECT condition, count(*) AS n FROM samples GROUP BY condition""")
def q_condition_counts(spark, d):
    return R.value_counts(A.samples(spark, d), "condition")


@register("design_balance", cte("samples") + """
SELECT patient, metastasis, normal, tumor,
       least(metastasis, normal, tumor) = 1 AND greatest(metastasis, normal, tumor) = 1 AS balanced
FROM (SELECT patient,
             count(*) FILTER (WHERE condition = 'metastasis') AS metastasis,
             count(*) FILTER (WHERE condition = 'normal') AS normal,
             count(*) FILTER (WHERE condition = 'tumor') AS tumor
      FROM samples GROUP BY patient)""")
def q_design_balance(spark, d):
    return R.design_balance(A.samples(spark, d), "patient", "condition", ["metastasis", "normal", "tumor"])


@register("keep_samples", cte("counts_long", "samples") + """
SELECT c.gene_id, c.sample_id, c.count FROM counts_long c
WHERE c.sample_id IN (SELECT sample_id FROM samples WHERE condition IS NOT NULL)""")
def q_keep_samples(spark, d):
    cells = A.study_cells(spark, d)
    kept, _ = R.keep_samples(A.counts_long(spark, d, cells), A.samples(spark, d, cells), "condition")
    return kept


@register("alignment_check", cte("counts_long", "samples", "qc") + """
SELECT coalesce(a.sid, b.sid, c.sid) AS sample_id,
       a.sid IS NOT NULL AS in_counts, b.sid IS NOT NULL AS in_metadata, c.sid IS NOT NULL AS in_qc
FROM (SELECT DISTINCT sample_id AS sid FROM counts_long) a
FULL OUTER JOIN (SELECT sample_id AS sid FROM samples) b ON a.sid = b.sid
FULL OUTER JOIN (SELECT external_id AS sid FROM qc) c ON coalesce(a.sid, b.sid) = c.sid""")
def q_alignment_check(spark, d):
    cells = A.study_cells(spark, d)
    qc = A.qc_table(spark, d, cells).withColumnRenamed("external_id", "sample_id")
    return R.check_alignment(A.counts_long(spark, d, cells), A.samples(spark, d, cells), qc)


@register("strip_version", cte("counts_long") + """
SELECT DISTINCT gene_id, split_part(gene_id, '.', 1) AS gene_key FROM counts_long""")
def q_strip_version(spark, d):
    return A.counts_long(spark, d).select("gene_id", T.strip_version("gene_id").alias("gene_key")).distinct()
