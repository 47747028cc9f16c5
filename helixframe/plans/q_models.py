"""Registered model queries (rows-only in the SQL compare; checked by tests against numpy)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import explore as X
from helixframe.operators import glm as G
from helixframe.operators import normalize as N
from helixframe.operators.reshape import with_sample_array
from helixframe.plans.pipeline import de_table, deseq, expression_inputs

Q: dict = {}

REF = {"condition": "normal"}
CONTRAST = ("condition", "tumor", "normal")


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


@register("dispersion_mle")
def q_dispersion_mle(spark, d):
    """D3: gene-wise Cox-Reid dispersion, design ~condition."""
    ctx = expression_inputs(spark, d)
    Xm, _ = G.design_matrix(ctx.design, ["condition"], REF)
    return G.genewise_dispersion(ctx.gene_vec, Xm, ctx.sf_array).select("gene_id", "base_mean", "disp_moment", "alpha_gw")


@register("dispersion_trend")
def q_dispersion_trend(spark, d):
    """Parametric trend coefficients (one row)."""
    ctx = expression_inputs(spark, d)
    Xm, _ = G.design_matrix(ctx.design, ["condition"], REF)
    from helixframe.session import cut_lineage
    disp = cut_lineage(G.genewise_dispersion(ctx.gene_vec, Xm, ctx.sf_array))
    t = G.dispersion_trend(disp)
    return spark.createDataFrame([(t["a0"], t["a1"], t["n_genes"], t["parametric"])],
                                 "a0 double, a1 double, n_genes long, parametric boolean")


@register("dispersion_map")
def q_dispersion_map(spark, d):
    """MAP dispersions with the trend and prior."""
    m = deseq(expression_inputs(spark, d), ["condition"], REF)
    return m.fit.select("gene_id", "alpha_gw", "alpha_trend", "alpha_map", "alpha")


@register("nb_fit_single")
def q_nb_fit_single(spark, d):
    """~condition fit; coefficients in log2 units."""
    m = deseq(expression_inputs(spark, d), ["condition"], REF)
    return m.fit.select("gene_id", "converged",
                        *[(F.col("beta")[i] / F.lit(G.LN2)).alias(f"b{i}") for i in range(len(m.names))])


@register("nb_fit_blocked")
def q_nb_fit_blocked(spark, d):
    """~patient + condition fit, patients eliminated; coefficients: intercept, patients, conditions."""
    m = deseq(expression_inputs(spark, d), ["patient", "condition"], REF)
    p = len(m.names) - m.n_blocks
    order = [0, *range(p, len(m.names)), *range(1, p)]
    return m.fit.select("gene_id", "converged",
                        *[(F.col("beta")[i] / F.lit(G.LN2)).alias(f"b{k}") for k, i in enumerate(order)])


@register("cooks_outliers")
def q_cooks_outliers(spark, d):
    """Genes with Cook's outliers and replaced genes, per design."""
    ctx = expression_inputs(spark, d)
    out = None
    for name, factors in (("single", ["condition"]), ("blocked", ["patient", "condition"])):
        m = deseq(ctx, factors, REF)
        s = m.fit.agg(F.count_if(F.col("n_cook_outliers") > 0).alias("n_outlier_genes"),
                      F.count_if(F.col("n_replaced") > 0).alias("n_replaced_genes")) \
            .select(F.lit(name).alias("design"), "*")
        out = s if out is None else out.unionByName(s)
    return out


@register("wald_contrast")
def q_wald_contrast(spark, d):
    """D9 + D10: tumor vs normal, ~condition, with independent filtering and BH."""
    res, _, _ = de_table(spark, d, ["condition"], CONTRAST, REF, "single")
    return res.select("contrast", "gene_id", "base_mean", "log2_fold_change", "lfc_se", "stat", "pvalue", "padj", "symbol")


@register("wald_contrast_blocked")
def q_wald_contrast_blocked(spark, d):
    """D9 + D10 under ~patient + condition."""
    res, _, _ = de_table(spark, d, ["patient", "condition"], CONTRAST, REF, "blocked")
    return res.select("contrast", "gene_id", "base_mean", "log2_fold_change", "lfc_se", "stat", "pvalue", "padj", "symbol")


@register("lfc_shrink")
def q_lfc_shrink(spark, d):
    """Cauchy-prior shrunken LFCs of the single-factor contrast."""
    res, _, _ = de_table(spark, d, ["condition"], CONTRAST, REF, "single")
    out, _ = G.shrink_lfc(res)
    return out.select("gene_id", "log2_fold_change", "lfc_shrunk", "lfc_shrunk_se")


@register("pca_scores")
def q_pca_scores(spark, d):
    """Two principal components of the VST matrix (trend from D4), samples as rows."""
    ctx = expression_inputs(spark, d)
    Xm, _ = G.design_matrix(ctx.design, ["condition"], REF)
    from helixframe.session import cut_lineage
    disp = cut_lineage(G.genewise_dispersion(ctx.gene_vec, Xm, ctx.sf_array))
    t = G.dispersion_trend(disp)
    a0, a1 = (t["a0"], t["a1"]) if t["parametric"] else (t["a0"], 0.0)
    gv = with_sample_array(ctx.gene_vec, "__sf", ctx.sf_array)
    v = gv.select(F.zip_with("y", "__sf", lambda y, s: N.vst_value(y / s, max(a0, 1e-8), a1)).alias("v"))
    scores, ratios = X.pca(v, ctx.n_samples, 2)
    r = spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(ratios)], "pc int, explained double")
    ids = ctx.samples.select("sample_idx", "sample_id", "condition")
    return scores.join(ids, "sample_idx").join(r, "pc")


def _fit_table(spark, d):
    """Deterministic 3-coefficient fit table (beta, row-major covariance) from ``part``."""
    from helixframe.sources.tables import read_table
    p = read_table(spark, d, "part", "p_partkey", "p_size", "p_retailprice")
    k, s = F.col("p_partkey"), F.col("p_size")
    b1 = ((k * 37) % 81 - 40).cast("double") / 10.0
    b2 = ((k * 13) % 41 - 20).cast("double") / 10.0
    v1 = F.lit(0.01) + (k % 10).cast("double") / 100.0
    v2 = F.lit(0.02) + (s % 7).cast("double") / 100.0
    c12 = F.lit(0.005) * ((k % 3) - 1).cast("double")
    z = F.lit(0.0)
    return p.select(F.concat(F.lit("ENSG"), F.lpad(k.cast("string"), 11, "0")).alias("gene_id"),
                    F.col("p_retailprice").alias("base_mean"),
                    F.array(F.ln("p_retailprice"), b1, b2).alias("beta"),
                    F.array(F.lit(0.05), z, z, z, v1, c12, z, c12, v2).alias("cov"),
                    F.lit(0).alias("n_cook_outliers"))


@register("wald_z", """
SELECT 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS gene_id,
       round((b1 - b2) / ln(2), 6) AS log2_fold_change,
       round(sqrt(v1 + v2 - 2 * c12) / ln(2), 6) AS lfc_se,
       round((b1 - b2) / sqrt(v1 + v2 - 2 * c12), 6) AS stat
FROM (SELECT p_partkey,
             CAST((p_partkey * 37) % 81 - 40 AS DOUBLE) / 10.0 AS b1,
             CAST((p_partkey * 13) % 41 - 20 AS DOUBLE) / 10.0 AS b2,
             0.01 + CAST(p_partkey % 10 AS DOUBLE) / 100.0 AS v1,
             0.02 + CAST(p_size % 7 AS DOUBLE) / 100.0 AS v2,
             0.005 * CAST((p_partkey % 3) - 1 AS DOUBLE) AS c12
      FROM part)""")
def q_wald_z(spark, d):
    """D9 arithmetic: contrast of two non-reference levels, c = (0, 1, -1), on stored
    beta / covariance arrays: LFC, SE (log2) and z."""
    w = G.wald(_fit_table(spark, d), [0.0, 1.0, -1.0], "c")
    return w.select("gene_id", F.round("log2_fold_change", 6).alias("log2_fold_change"),
                    F.round("lfc_se", 6).alias("lfc_se"), F.round("stat", 6).alias("stat"))


_SHRINK_SQL = """
WITH w AS (
  SELECT 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS gene_id, (b1 - b2) / ln(2) AS lfc, sqrt(v1 + v2 - 2 * c12) / ln(2) AS se
  FROM (SELECT p_partkey, CAST((p_partkey * 37) % 81 - 40 AS DOUBLE) / 10.0 AS b1, CAST((p_partkey * 13) % 41 - 20 AS DOUBLE) / 10.0 AS b2,
               0.01 + CAST(p_partkey % 10 AS DOUBLE) / 100.0 AS v1, 0.02 + CAST(p_size % 7 AS DOUBLE) / 100.0 AS v2,
               0.005 * CAST((p_partkey % 3) - 1 AS DOUBLE) AS c12 FROM part)),
prior AS (SELECT greatest(avg(lfc * lfc - se * se), 1e-4) AS s2 FROM w),
-- the best of a dense grid between 0 and the raw value, then Newton steps from there
g1 AS (SELECT gene_id, lfc, se, s2, arg_min(lfc * i / 1000.0, power(lfc * i / 1000.0 - lfc, 2) / (2 * se * se) + ln(s2 + power(lfc * i / 1000.0, 2))) AS b
       FROM w, prior, range(0, 1001) t(i) GROUP BY gene_id, lfc, se, s2),
""" + "\n".join(
    f"n{k} AS (SELECT gene_id, lfc, se, s2, b - ((b - lfc) / (se * se) + 2 * b / (s2 + b * b))"
    f" / (1 / (se * se) + 2 * (s2 - b * b) / power(s2 + b * b, 2)) AS b FROM {'g1' if k == 1 else f'n{k - 1}'}),"
    for k in range(1, 6)) + """
done AS (SELECT 1)
SELECT gene_id, round(lfc, 6) AS log2_fold_change, round(b, 6) + 0.0 AS lfc_shrunk FROM n5"""


@register("lfc_shrink_z", _SHRINK_SQL)
def q_lfc_shrink_z(spark, d):
    """D11 on the Wald table of stored coefficients; the SQL twin finds the mode by a dense search and Newton steps."""
    out, _ = G.shrink_lfc(G.wald(_fit_table(spark, d), [0.0, 1.0, -1.0], "c"))
    return out.select("gene_id", F.round("log2_fold_change", 6).alias("log2_fold_change"),
                      (F.round("lfc_shrunk", 6) + F.lit(0.0)).alias("lfc_shrunk"))


@register("nb_fit_single_catalyst")
def q_nb_fit_single_catalyst(spark, d):
    """D6 without a Python worker: moment dispersions (Catalyst) and the cell-means
    Newton fit as Spark ``aggregate`` expressions; LFC / SE / z of tumor vs normal."""
    ctx = expression_inputs(spark, d)
    mom = N.dispersion_moments(ctx.gene_vec, ctx.sf_array).select("gene_id", F.col("disp_moment").alias("alpha"))
    gv = ctx.gene_vec.join(mom.where(F.col("alpha").isNotNull()), "gene_id")
    fit = G.fit_single_factor(gv, ctx.design, "condition", "normal", ctx.sf_array)
    names = ["Intercept"] + [f"condition[T.{lv}]" for lv in sorted({r["condition"] for r in ctx.design}) if lv != "normal"]
    c = G.contrast_vector(names, *CONTRAST)
    w = G.wald(fit.withColumn("base_mean", F.lit(None).cast("double")).withColumn("n_cook_outliers", F.lit(0)), c, "single")
    return w.select("gene_id", "log2_fold_change", "lfc_se", "stat")
