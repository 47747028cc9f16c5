"""Numeric operators against references written here with numpy / math."""

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from helixframe.functions import mathx as M
from helixframe.operators import glm as G
from helixframe.operators import results as RS


def _bh_numpy(p):
    p = np.asarray(p, float)
    order = np.argsort(p, kind="mergesort")
    m = len(p)
    q = p[order] * m / np.arange(1, m + 1)
    q = np.minimum.accumulate(q[::-1])[::-1]
    out = np.empty(m)
    out[order] = np.minimum(q, 1.0)
    return out


def test_bh_window_and_ranged_match_numpy(spark):
    rnd = random.Random(3)
    ps = [round(rnd.random() ** 3, 3) for _ in range(400)]   # many ties
    rows = [("c", f"g{i}", p) for i, p in enumerate(ps)] + [("c", "gnull", None)]
    df = spark.createDataFrame(rows, "contrast string, gene_id string, pvalue double")
    ref = dict(zip([f"g{i}" for i in range(len(ps))], _bh_numpy(ps)))
    a = {r.gene_id: r.padj_bh for r in RS.bh_adjust(df).collect()}
    b = {r.gene_id: r.padj_bh for r in RS.bh_adjust_ranged(df, n_parts=7).collect()}
    assert a["gnull"] is None and b["gnull"] is None
    for g, v in ref.items():
        assert abs(a[g] - v) < 1e-12 and abs(b[g] - v) < 1e-12
        assert a[g] >= dict(zip([f"g{i}" for i in range(len(ps))], ps))[g] - 1e-15


def test_lgamma_column_matches_math(spark):
    xs = [0.5, 1.0, 2.5, 7.0, 9.99, 10.0, 123.4, 1e6]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(M.lgamma("x")).collect()]
    for x, g in zip(xs, got):
        assert abs(g - math.lgamma(x)) <= 1e-12 * max(1.0, abs(math.lgamma(x)))
    assert np.allclose(M.lgamma_np(np.array(xs)), [math.lgamma(x) for x in xs], rtol=1e-12)


def test_ora_matches_exact_hypergeometric(spark):
    from helixframe.operators.enrich import ora
    bg = [f"s{i}" for i in range(60)]
    lists = [("up", g) for g in bg[:12]]
    sets = [("T1", g) for g in bg[5:25]] + [("T2", g) for g in bg[40:45]] + [("T3", g) for g in bg[:3]]
    res = ora(spark.createDataFrame(lists, "direction string, symbol string"),
              spark.createDataFrame(sets, "term string, symbol string"),
              spark.createDataFrame([(g,) for g in bg], "symbol string")).collect()
    N, n = 60, 12
    for r in res:
        K, k = r.set_size, r.overlap
        p = sum(math.comb(K, i) * math.comb(N - K, n - i) for i in range(k, min(K, n) + 1)) / math.comb(N, n)
        assert abs(r.pvalue - p) < 1e-12
    assert {r.term for r in res} == {"T1", "T3"}     # T2 shares no gene with the list


def test_f_quantile_and_trigamma():
    assert abs(M.f_quantile(0.99, 1, 10) - 10.0443) < 1e-3
    assert abs(M.f_quantile(0.5, 2, 2) - 1.0) < 1e-9
    assert abs(M.trigamma(1.0) - math.pi ** 2 / 6) < 1e-10


def test_irls_poisson_limit_equals_group_ratio():
    rng = np.random.default_rng(1)
    design = [{"c": "a"}] * 4 + [{"c": "b"}] * 5
    X, names = G.design_matrix(design, ["c"])
    s = rng.uniform(0.5, 2.0, size=9)
    Y = rng.poisson(lam=50 * s[None, :] * np.array([1] * 4 + [3] * 5)[None, :], size=(6, 9)).astype(float)
    beta, _, _, conv = G._irls(Y, X, s, np.full(6, 1e-8))
    assert conv.all()
    ga = Y[:, :4].sum(1) / s[:4].sum()
    gb = Y[:, 4:].sum(1) / s[4:].sum()
    assert np.allclose(np.exp(beta[:, 0]), ga, rtol=1e-6)
    assert np.allclose(np.exp(beta[:, 0] + beta[:, 1]), gb, rtol=1e-6)


def test_design_rank_check():
    import pytest
    design = [{"p": "x", "c": "a"}, {"p": "y", "c": "b"}]
    with pytest.raises(ValueError):
        G.design_matrix(design, ["p", "c"])


def test_wald_pvalue_matches_erfc(spark):
    fit = spark.createDataFrame([("g", 10.0, [1.0, 0.7], [0.04, 0.0, 0.0, 0.09], 0)],
                                "gene_id string, base_mean double, beta array<double>, cov array<double>, n_cook_outliers int")
    r = G.wald(fit, [0.0, 1.0]).first()
    assert abs(r.log2_fold_change - 0.7 / math.log(2)) < 1e-12
    assert abs(r.stat - 0.7 / 0.3) < 1e-12
    assert abs(r.pvalue - math.erfc(abs(0.7 / 0.3) / math.sqrt(2))) < 1e-15


def test_size_factor_scales_with_sample(spark):
    from helixframe.operators.normalize import size_factors
    rows = []
    for g in range(30):
        for j, mult in enumerate([1, 1, 2]):
            rows.append((f"g{g}", f"s{j}", (g + 3) * 7 * mult + (j if mult == 1 else 0) * 0))
    df = spark.createDataFrame(rows, "gene_id string, sample_id string, count long")
    sf = {r.sample_id: r.size_factor for r in size_factors(df, 3).collect()}
    assert abs(sf["s2"] / sf["s0"] - 2.0) < 1e-12


def test_pca_matches_numpy(spark):
    from helixframe.operators.explore import pca
    rng = np.random.default_rng(0)
    M_ = rng.normal(size=(50, 6))          # 50 genes x 6 samples
    df = spark.createDataFrame([(list(map(float, r)),) for r in M_], "v array<double>")
    scores, ratios = pca(df, 6, 2)
    Xs = M_.T - M_.T.mean(axis=0)            # samples x genes, centred per gene
    U, S, Vt = np.linalg.svd(Xs, full_matrices=False)
    ref_ratio = (S ** 2 / (S ** 2).sum())[:2]
    assert np.allclose(ratios, ref_ratio, atol=1e-9)
    got = np.zeros((6, 2))
    for r in scores.collect():
        got[r.sample_idx, r.pc - 1] = r.score
    ref = U[:, :2] * S[:2]
    for c in range(2):
        assert np.allclose(np.abs(got[:, c]), np.abs(ref[:, c]), atol=1e-8)


def test_shrinkage_pulls_toward_zero(spark):
    df = spark.createDataFrame([(f"g{i}", float(l), float(s)) for i, (l, s) in
                                enumerate([(5.0, 3.0), (0.2, 0.1), (-4.0, 0.2), (1.0, 2.0)])],
                               "gene_id string, log2_fold_change double, lfc_se double")
    out, S = G.shrink_lfc(df)
    for r in out.collect():
        assert abs(r.lfc_shrunk) <= abs(r.log2_fold_change) + 1e-12
        assert r.lfc_shrunk * r.log2_fold_change >= 0


def test_exact_quantiles_match_numpy(spark):
    from helixframe.operators.stats import exact_quantiles, exact_median
    rng = np.random.default_rng(2)
    vals = {"a": rng.integers(0, 20, 101).astype(float), "b": rng.normal(size=50), "c": np.array([3.0])}
    rows = [(g, float(v)) for g, arr in vals.items() for v in arr] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    med = {r.g: r.v for r in exact_median(df, "v", "g").collect()}
    for g, arr in vals.items():
        assert abs(med[g] - np.median(arr)) < 1e-12
    qs = [0.0, 0.1, 0.25, 0.9, 1.0]
    got = {round(r.q, 6): r.v for r in exact_quantiles(df, "v", qs).collect()}
    allv = np.concatenate(list(vals.values()))
    for q in qs:
        assert abs(got[round(q, 6)] - np.quantile(allv, q)) < 1e-12


def test_exact_quantiles_with_many_ranges_and_ties(spark):
    from helixframe.operators.stats import exact_quantiles
    rng = np.random.default_rng(9)
    vals = {"x": rng.normal(size=20_000), "y": np.r_[np.full(9000, 2.5), rng.normal(size=500)], "z": np.array([1.0, 1.0])}
    df = spark.createDataFrame([(g, float(v)) for g, a in vals.items() for v in a] + [(None, 4.0), (None, 6.0)], "g string, v double")
    for parts in (3, 40):
        got = {(r.g, round(r.q, 6)): r.v for r in exact_quantiles(df, "v", [0.0, 0.3, 0.5, 1.0], "g", n_parts=parts).collect()}
        for g, a in (*vals.items(), (None, np.array([4.0, 6.0]))):
            for q in (0.0, 0.3, 0.5, 1.0):
                assert abs(got[g, q] - np.quantile(a, q)) < 1e-12


def _bh(p):
    o = np.argsort(p, kind="stable")
    q = p[o] * len(p) / np.arange(1, len(p) + 1)
    out = np.empty(len(p))
    out[o] = np.minimum(1.0, np.minimum.accumulate(q[::-1])[::-1])
    return out


def test_bh_matches_numpy_on_many_rows(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    p = np.r_[rng.random(120_000), rng.random(30_000) ** 4, np.full(50_000, 0.75)]      # a quarter tied
    rng.shuffle(p)
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(p)), "pvalue": p}))
    want = _bh(p)
    for parts in (8, 64):
        got = RS.bh_adjust_ranged(df, n_parts=parts).toPandas().sort_values("i")["padj_bh"].to_numpy()
        assert np.abs(got - want).max() < 1e-12
    two = df.withColumn("contrast", F.when(F.col("i") < 50_000, "a"))                   # a null group too
    got = RS.bh_adjust(two, n_parts=16).toPandas().sort_values("i")["padj_bh"].to_numpy()
    assert np.abs(got - np.r_[_bh(p[:50_000]), _bh(p[50_000:])]).max() < 1e-12


def test_independent_filter_matches_a_loop_over_thresholds(spark):
    rng = np.random.default_rng(5)
    n = 3000
    bm = rng.lognormal(3, 2, n)
    p = np.where((rng.random(n) < 0.1) & (bm > 20), rng.random(n) * 1e-4, rng.random(n))
    pdf = pd.DataFrame({"gene_id": [f"g{i}" for i in range(n)], "base_mean": bm, "pvalue": p})
    res, theta = G.independent_filter(spark.createDataFrame(pdf), 0.05)
    grid = np.quantile(bm, np.arange(50) / 50)
    n_rej = [(_bh(p[bm >= t]) < 0.05).sum() for t in grid]
    assert abs(theta - grid[int(np.argmax(n_rej))]) < 1e-9
    got = res.toPandas().set_index("gene_id").loc[pdf["gene_id"], "padj"].to_numpy()
    keep = bm >= theta
    assert np.isnan(got[~keep]).all() and np.abs(got[keep] - _bh(p[keep])).max() < 1e-12


def test_shrinkage_is_the_mode_between_zero_and_the_raw_value(spark):
    rng = np.random.default_rng(8)
    lfc = np.r_[rng.normal(0, 2, 300), 0.0, 4.0, -4.0, 30.0, 1e-9]
    se = np.r_[rng.lognormal(-0.5, 1, 300), 1.0, 5.0, 5.0, 0.01, 2.0]
    df = spark.createDataFrame(pd.DataFrame({"gene_id": [f"g{i}" for i in range(len(lfc))], "log2_fold_change": lfc, "lfc_se": se}))
    out, S = G.shrink_lfc(df)
    got = out.toPandas().set_index("gene_id")["lfc_shrunk"]
    for i, (b, s) in enumerate(zip(lfc, se, strict=True)):
        x = np.linspace(0, b, 20_001)
        cost = (x - b) ** 2 / (2 * s * s) + np.log(S * S + x * x)
        g = got[f"g{i}"]
        assert min(0, b) - 1e-9 <= g <= max(0, b) + 1e-9
        assert (g - b) ** 2 / (2 * s * s) + np.log(S * S + g * g) <= cost.min() + 1e-7


def test_shrinkage_by_coefficient_name(spark):
    import pytest
    fit = spark.createDataFrame([("g", 10.0, [1.0, 0.7], [0.04, 0.0, 0.0, 0.09], 0)],
                                "gene_id string, base_mean double, beta array<double>, cov array<double>, n_cook_outliers int")
    r = G.shrink_coefficient(fit, ["Intercept", "c[T.b]"], "c[T.b]")[0].first()
    assert abs(r.log2_fold_change - 0.7 / math.log(2)) < 1e-12 and 0 <= r.lfc_shrunk <= r.log2_fold_change
    with pytest.raises(ValueError):
        G.shrink_coefficient(fit, ["Intercept"], "c[T.b]")


def _cook_case(spark, reps, factor):
    rng = np.random.default_rng(1)
    design = [{"c": "a"}] * reps + [{"c": "b"}] * reps
    X, names = G.design_matrix(design, ["c"])
    s = [1.0] * (2 * reps)
    Y = rng.negative_binomial(10, 10 / (10 + 100), size=(200, 2 * reps)).astype(float)
    Y[:5, 0] = np.floor(Y[:5, 1:reps].mean(1) * factor)                  # five genes with one outlier
    gv = spark.createDataFrame([(f"g{i}", list(map(float, y))) for i, y in enumerate(Y)], "gene_id string, y array<double>")
    from helixframe.session import cut_lineage
    disp = cut_lineage(G.genewise_dispersion(gv, X, s))
    trend = {"a0": 0.1, "a1": 1.0, "n_genes": 200, "parametric": True}
    fit = cut_lineage(G.fit_genes(disp, X, s, trend, {"prior_var": 0.25, "s_lr": 1.0}))
    w = {r.gene_id: r for r in G.wald(fit, [0.0, 1.0]).collect()}
    return {r.gene_id: r for r in fit.collect()}, w


def test_outliers_in_large_cells_are_replaced_and_refitted(spark):
    fit, w = _cook_case(spark, 8, 200)
    for i in range(5):
        r = fit[f"g{i}"]
        assert r.n_replaced == 1 and r.n_cook_outliers == 0
        assert w[f"g{i}"].pvalue is not None and abs(w[f"g{i}"].log2_fold_change) < 1.5
        assert r.alpha < 2.0                                          # the dispersion was fitted without the outlier
    assert sum(r.n_replaced > 0 for r in fit.values()) <= 15


def test_outliers_in_small_cells_lose_their_p_value(spark):
    fit, w = _cook_case(spark, 4, 400)
    for i in range(5):
        assert fit[f"g{i}"].n_cook_outliers >= 1 and fit[f"g{i}"].n_replaced == 0 and w[f"g{i}"].pvalue is None
    assert sum(r.pvalue is None for r in w.values()) <= 25


def test_dispersion_search_matches_a_dense_grid():
    rng = np.random.default_rng(6)
    X = np.column_stack([np.ones(12), np.repeat([0.0, 1.0], 6)])
    Y = rng.negative_binomial(4, 4 / (4 + 60), size=(220, 12)).astype(float)
    mu = np.maximum(np.tile(Y.mean(1, keepdims=True), (1, 12)), 0.5)
    got = np.log(G._maximise(Y, mu, X, math.log(1e-8), math.log(12)))
    grid = np.linspace(math.log(1e-8), math.log(12), 3000)
    best = grid[np.argmax(np.stack([G._cr_loglik(Y, mu, X, np.full(220, g)) for g in grid], 1), 1)]
    assert np.abs(got - best).max() < 0.01


def test_single_factor_catalyst_fit_matches_numpy_irls(spark):
    rng = np.random.default_rng(4)
    design = [{"c": "n"}] * 4 + [{"c": "t"}] * 3 + [{"c": "m"}] * 3
    s = rng.uniform(0.6, 1.8, size=10)
    Y = rng.negative_binomial(5, 5 / (5 + 40 * s), size=(12, 10)).astype(float) + 3
    alpha = rng.uniform(0.05, 0.5, size=12)
    X, names = G.design_matrix(design, ["c"], {"c": "n"})
    beta_np, XtWX, _, conv = G._irls(Y, X, s, alpha)
    df = spark.createDataFrame([(f"g{i}", float(alpha[i]), list(map(float, Y[i]))) for i in range(12)],
                               "gene_id string, alpha double, y array<double>")
    got = {r.gene_id: r for r in G.fit_single_factor(df, design, "c", "n", list(s)).collect()}
    cov_np = np.linalg.inv(XtWX)
    # numpy column order follows sorted levels: Intercept, c[T.m], c[T.t]; the Catalyst
    # path orders non-reference levels the same way (sorted)
    for i in range(12):
        r = got[f"g{i}"]
        assert np.allclose(r.beta, beta_np[i], atol=1e-5)
        assert np.allclose(np.array(r.cov).reshape(3, 3), cov_np[i], rtol=1e-4, atol=1e-8)


def test_plans_do_not_grow_with_samples(spark):
    """Per-sample factors are data, no literals."""
    import numpy as np
    from helixframe.operators import glm as G
    from helixframe.operators import normalize as N

    def sizes(m):
        y = np.random.default_rng(1).poisson(20, m).astype(float)
        gv = spark.createDataFrame([("g", y.tolist(), 0.1)], "gene_id string, y array<double>, alpha double")
        design = [{"c": "nt"[i % 2]} for i in range(m)]
        plans = [N.dispersion_moments(gv, [1.0 + i / m for i in range(m)]), N.vst(gv, [1.0] * m, 0.05, 3.0),
                 G.fit_single_factor(gv, design, "c", "n", [1.0] * m)]
        assert all(p.count() for p in plans)
        return [len(p._jdf.queryExecution().analyzed().toString().splitlines()) + len(p._jdf.queryExecution().analyzed().toString()) // 2000 for p in plans]
    assert sizes(16) == sizes(5000)
