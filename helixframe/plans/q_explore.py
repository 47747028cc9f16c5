"""Registered queries: variance-stabilised counts, z-scores, distances, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import enrich as E
from helixframe.operators import explore as X
from helixframe.operators import normalize as N
from helixframe.operators import results as RS
from helixframe.plans import adapters as A
from helixframe.plans.oracle import cte
from helixframe.plans.pipeline import expression_inputs

Q: dict = {}

# Fixed trend used by the oracle-checked VST (a real run takes them from D4).
VST_A0, VST_A1 = 0.05, 3.0


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def _r6(c):
    return F.round(c, 6)


_DENSE = """
pos AS (SELECT gene_id, sample_id, ln(count) AS lv FROM counts_long WHERE count > 0),
lgm AS (SELECT gene_id, avg(lv) AS lgm FROM pos GROUP BY gene_id
        HAVING count(*) = (SELECT count(*) FROM samples)),
sf AS (SELECT sample_id, exp(quantile_cont(lv - lgm, 0.5)) AS size_factor FROM pos JOIN lgm USING (gene_id) GROUP BY sample_id),
keep AS (SELECT gene_id FROM counts_long GROUP BY gene_id HAVING sum(count) >= 10),
dense AS (SELECT k.gene_id, s.sample_id, coalesce(c.count, 0) AS count
          FROM keep k CROSS JOIN samples s LEFT JOIN counts_long c ON c.gene_id = k.gene_id AND c.sample_id = s.sample_id),
qn AS (SELECT gene_id, sample_id, count / size_factor AS q FROM dense JOIN sf USING (sample_id)),
vst AS (SELECT gene_id, sample_id,
               log2((4.0 + 0.1 * q + 2.0 * sqrt(0.05 * q * (4.0 + 0.05 * q))) / 0.2) AS vst FROM qn)"""

_ORA = """
bg AS (SELECT DISTINCT contrast, symbol AS g FROM de_results WHERE symbol IS NOT NULL),
lists AS (SELECT DISTINCT contrast, CASE WHEN log2_fold_change > 1 THEN 'up' ELSE 'down' END AS lk, symbol AS g
          FROM de_results WHERE symbol IS NOT NULL AND padj < 0.05 AND (log2_fold_change > 1 OR log2_fold_change < -1)),
sets AS (SELECT DISTINCT contrast, term, symbol AS g FROM gene_sets JOIN bg ON symbol = g),
nl AS (SELECT contrast, lk, count(*) AS n FROM lists GROUP BY ALL),
kt AS (SELECT contrast, term, count(*) AS kk FROM sets GROUP BY ALL),
nb AS (SELECT contrast, count(*) AS nn FROM bg GROUP BY ALL),
ov AS (SELECT contrast, lk, term, count(*) AS k FROM lists JOIN sets USING (contrast, g) GROUP BY ALL),
pairs AS (SELECT contrast, lk, term, k, kk, n, nn
          FROM ov JOIN nl USING (contrast, lk) JOIN kt USING (contrast, term) JOIN nb USING (contrast)),
tail AS (SELECT contrast, lk, term, k, kk, n, least(1.0, sum(CASE WHEN i <= least(kk, n) AND n - i <= nn - kk THEN exp(
            lgamma(kk + 1) - lgamma(i + 1) - lgamma(kk - i + 1)
          + lgamma(nn - kk + 1) - lgamma(n - i + 1) - lgamma(nn - kk - n + i + 1)
          - (lgamma(nn + 1) - lgamma(n + 1) - lgamma(nn - n + 1))) ELSE 0 END)) AS p
         FROM (SELECT *, unnest(range(k, greatest(least(kk, n), k) + 1)) AS i FROM pairs) GROUP BY ALL),
ora AS (SELECT contrast, lk AS direction, term, k AS overlap, kk AS set_size, n AS list_size, p AS pvalue,
           least(1.0, min(p * m / r) OVER (PARTITION BY contrast, lk ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padj
     FROM (SELECT *, count(*) OVER (PARTITION BY contrast, lk) AS m,
                  count(*) OVER (PARTITION BY contrast, lk ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r
           FROM tail))"""


def _vst_long(spark, d, a0=VST_A0, a1=VST_A1):
    ctx = expression_inputs(spark, d)
    v = N.vst(ctx.gene_vec, ctx.sf_array, a0, a1)
    return v.join(F.broadcast(ctx.samples.select("sample_idx", "sample_id")), "sample_idx")


def _heat_genes(spark, d):
    from helixframe.plans.q_results import de_results
    return RS.heatmap_genes(de_results(spark, d), 20).select("contrast", "gene_id")


_HEAT_SQL = """,
hg AS (SELECT contrast, gene_id FROM (SELECT contrast, gene_id, row_number() OVER (PARTITION BY contrast ORDER BY padj ASC NULLS LAST, gene_id) AS r
       FROM de_results WHERE symbol IS NOT NULL) WHERE r <= 20),
hv AS (SELECT contrast, vst.* FROM vst JOIN hg USING (gene_id)),
hz AS (SELECT contrast, gene_id, sample_id, CASE WHEN stddev_pop(vst) OVER w > 0
              THEN (vst - avg(vst) OVER w) / stddev_pop(vst) OVER w END AS z
       FROM hv WINDOW w AS (PARTITION BY contrast, gene_id))"""


@register("vst_counts", cte("counts_long", "samples", extra=_DENSE) + """
SELECT gene_id, sample_id, round(vst, 6) AS vst FROM vst""")
def q_vst_counts(spark, d):
    """D12 with a fixed trend (a0 = 0.05, a1 = 3) on dense gene arrays."""
    return _vst_long(spark, d).select("gene_id", "sample_id", _r6("vst").alias("vst"))


@register("dispersion_moments", cte("counts_long", "samples", extra=_DENSE + """,
st AS (SELECT gene_id, avg(q) AS mu, var_samp(q) AS v FROM qn GROUP BY gene_id),
ia AS (SELECT avg(1.0 / size_factor) AS ia FROM sf)""") + """
SELECT gene_id, round(mu, 6) AS mean_norm, round(v, 6) AS var_norm,
       round(CASE WHEN mu > 0 THEN greatest((v - mu * (SELECT ia FROM ia)) / (mu * mu), 1e-8) END, 6) AS disp_moment
FROM st""")
def q_dispersion_moments(spark, d):
    ctx = expression_inputs(spark, d)
    m = N.dispersion_moments(ctx.gene_vec, ctx.sf_array)
    return m.select("gene_id", _r6("mean_norm").alias("mean_norm"), _r6("var_norm").alias("var_norm"),
                    _r6("disp_moment").alias("disp_moment"))


@register("heatmap_z", cte("counts_long", "samples", "de_results", extra=_DENSE + _HEAT_SQL) + """
SELECT contrast, gene_id, sample_id, round(z, 6) AS z FROM hz""")
def q_heatmap_z(spark, d):
    """W4 -> J11 -> D14: z-scored VST rows of the 20 most significant mapped genes of every contrast."""
    rows = X.rows_for(_vst_long(spark, d), _heat_genes(spark, d), by="contrast")
    return X.zscore_rows(rows, ["contrast", "gene_id"]).select("contrast", "gene_id", "sample_id", _r6("z").alias("z"))


@register("heatmap_distances", cte("counts_long", "samples", "de_results", extra=_DENSE + _HEAT_SQL + """,
one AS (SELECT gene_id, sample_id, z FROM hz WHERE contrast = 'single')""") + """
SELECT 'genes' AS axis, a.gene_id AS a, b.gene_id AS b, round(sqrt(sum((a.z - b.z) * (a.z - b.z))), 6) AS dist
FROM one a JOIN one b USING (sample_id) GROUP BY ALL
UNION ALL
SELECT 'samples', a.sample_id, b.sample_id, round(sqrt(sum((a.z - b.z) * (a.z - b.z))), 6)
FROM one a JOIN one b USING (gene_id) GROUP BY ALL""")
def q_heatmap_distances(spark, d):
    """Gene-gene and sample-sample Euclidean distances of the first contrast's heatmap z matrix."""
    z = X.zscore_rows(X.rows_for(_vst_long(spark, d), _heat_genes(spark, d).where(F.col("contrast") == "single")))
    g = X.distance_matrix(z, "gene_id", "sample_id").select(F.lit("genes").alias("axis"), "a", "b", "dist")
    s = X.distance_matrix(z, "sample_id", "gene_id").select(F.lit("samples").alias("axis"), "a", "b", "dist")
    return g.unionByName(s).select("axis", "a", "b", _r6("dist").alias("dist"))


def _ora(spark, d):
    from helixframe.plans.q_results import de_results
    res = de_results(spark, d)
    bg = res.where(F.col("symbol").isNotNull()).select("contrast", "symbol")
    return E.ora(RS.de_lists(res), A.gene_sets(spark, d), bg, within="contrast")


@register("ora", cte("de_results", "gene_sets", extra=_ORA) + """
SELECT contrast, direction, term, overlap, set_size, list_size, round(pvalue, 6) AS pvalue, round(padj, 6) AS padj FROM ora""")
def q_ora(spark, d):
    """D15 + J10: up / down lists of every contrast against the gene sets."""
    return _ora(spark, d).select("contrast", "direction", "term", "overlap", "set_size", "list_size",
                                 _r6("pvalue").alias("pvalue"), _r6("padj").alias("padj"))


@register("top_terms", cte("de_results", "gene_sets", extra=_ORA) + """
SELECT contrast, direction, term, rank FROM (
  SELECT contrast, direction, term,
         CAST(row_number() OVER (PARTITION BY contrast, direction ORDER BY padj ASC NULLS LAST, term) AS INTEGER) AS rank
  FROM ora) WHERE rank <= 10""")
def q_top_terms(spark, d):
    return E.top_terms(_ora(spark, d), 10, ["contrast", "direction"]).select("contrast", "direction", "term", "rank")


@register("compare_terms", cte("de_results", "gene_sets", extra=_ORA) + """
SELECT coalesce(a.direction, b.direction) AS direction, coalesce(a.term, b.term) AS term,
       CASE WHEN a.term IS NOT NULL THEN 'a' ELSE 'b' END AS only_in
FROM (SELECT direction, term FROM ora WHERE contrast = 'single' AND padj < 0.5) a
FULL OUTER JOIN (SELECT direction, term FROM ora WHERE contrast = 'blocked' AND padj < 0.5) b
  ON a.direction = b.direction AND a.term = b.term
WHERE a.term IS NULL OR b.term IS NULL""")
def q_compare_terms(spark, d):
    """Terms under a padj limit in one model only (a = single, b = blocked); at 0.5, as
    these tables hold no term under 0.05 in either."""
    both = _ora(spark, d)
    return E.compare_terms(*(both.where(F.col("contrast") == c) for c in ("single", "blocked")), alpha=0.5)
