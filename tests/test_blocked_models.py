"""D4, D5 and D7 against plain numpy: dense matrices, dense likelihood grids, a gamma fit written here."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions.mathx import trigamma
from helixframe.operators import glm as G
from helixframe.session import cut_lineage


def _study(patients, genes, seed=0, per_patient=3):
    """Counts of ``genes`` genes for ``patients`` patients of ``per_patient`` conditions each, with patient effects."""
    rng = np.random.default_rng(seed)
    design = [{"patient": f"p{i:04d}", "condition": c} for i in range(patients) for c in "ntm"[:per_patient]]
    m = len(design)
    s = rng.uniform(0.6, 1.7, m)
    base, effect = rng.uniform(20, 400, genes), rng.normal(0, 0.5, genes)
    patient = np.repeat(rng.normal(0, 0.4, (genes, patients)), per_patient, axis=1)
    tumor = np.array([r["condition"] == "t" for r in design])
    mu = base[:, None] * s * np.exp(patient + effect[:, None] * tumor)
    alpha = 0.05 + 3 / base
    Y = rng.negative_binomial(1 / alpha[:, None], 1 / (1 + alpha[:, None] * mu)).astype(float)
    return design, s, Y, alpha


def _dense(D):
    """The whole model matrix of a design, column by column."""
    return np.column_stack([D.A] + [(D.block == k + 1).astype(float) for k in range(D.n_blocks)])


def _dense_irls(y, X, s, alpha):
    """One gene by ordinary IRLS on the dense matrix: beta, covariance, mu."""
    beta = np.linalg.lstsq(X, np.log((y + 0.5) / s), rcond=None)[0]
    for _ in range(200):
        mu = np.maximum(np.exp(np.clip(X @ beta + np.log(s), -30, 30)), 0.5)
        w = mu / (1 + alpha * mu)
        new = np.linalg.solve(X.T @ (w[:, None] * X) + 1e-6 * np.eye(X.shape[1]),
                              X.T @ (w * (np.log(mu) - np.log(s) + (y - mu) / mu)))
        if np.abs(new - beta).max() < 1e-12:
            break
        beta = new
    mu = np.maximum(np.exp(np.clip(X @ beta + np.log(s), -30, 30)), 0.5)
    return beta, np.linalg.inv(X.T @ ((mu / (1 + alpha * mu))[:, None] * X) + 1e-6 * np.eye(X.shape[1])), mu


def _dense_objective(y, mu, X, la, trend=None, var=None):
    """Cox-Reid likelihood at log alpha ``la``, with the log-normal prior if given, by the textbook formula."""
    a = math.exp(la)
    lg = np.vectorize(math.lgamma)
    ll = (lg(y + 1 / a) - math.lgamma(1 / a) - lg(y + 1) + y * np.log(a * mu) - (y + 1 / a) * np.log1p(a * mu)).sum()
    ll -= 0.5 * np.linalg.slogdet(X.T @ ((mu / (1 + a * mu))[:, None] * X))[1]
    return ll if trend is None else ll - (la - math.log(trend)) ** 2 / (2 * var)


def _frame(spark, Y):
    return spark.createDataFrame([(f"g{i:04d}", y.tolist()) for i, y in enumerate(Y)], "gene_id string, y array<double>")


def test_blocked_fit_equals_dense_fit():
    design, s, Y, alpha = _study(30, 200)
    D = G.blocked_design(design, ["patient", "condition"], "patient", {"condition": "n"})
    X = _dense(D)
    assert D.shape == X.shape == (90, 32) and len(D.names) == 32 and D.names[0] == "Intercept"
    beta, normal, mu, conv = G._irls_normal(Y, D, s, alpha)
    cov, q = np.linalg.inv(normal.schur), D.A.shape[1]
    lev = normal.leverage(D, cov)
    for g in range(len(Y)):
        b, C, mu_d = _dense_irls(Y[g], X, s, alpha[g])
        assert np.allclose(beta[g], b, atol=2e-4) and np.allclose(mu[g], mu_d, rtol=1e-3)
        assert np.allclose(cov[g], C[:q, :q], rtol=1e-3, atol=1e-8)
        assert np.allclose(lev[g], np.einsum("mp,pq,mq->m", X, C, X), rtol=1e-3)
        w = mu[g] / (1 + alpha[g] * mu[g])
        full = X.T @ (w[:, None] * X) + 1e-6 * np.eye(X.shape[1])
        assert abs(normal.logdet()[g] - np.linalg.slogdet(full)[1]) < 1e-7
    assert conv.mean() > 0.95


def test_blocked_search_equals_a_dense_grid():
    design, s, Y, alpha = _study(6, 200, seed=3)
    D = G.blocked_design(design, ["patient", "condition"], "patient", {"condition": "n"})
    X = _dense(D)
    mu = G._irls_normal(Y, D, s, alpha)[2]
    lo, hi = math.log(1e-8), math.log(18)
    trend = np.full(len(Y), 0.1)
    got = {None: np.log(G._maximise(Y, mu, D, lo, hi)),
           0.5: np.log(G._maximise(Y, mu, D, lo, hi, np.log(trend), 0.5))}
    for var, la in got.items():
        for g in range(0, len(Y), 4):
            f = [_dense_objective(Y[g], mu[g], X, x, None if var is None else 0.1, var) for x in np.linspace(lo, hi, 250)]
            at = _dense_objective(Y[g], mu[g], X, la[g], None if var is None else 0.1, var)
            assert at >= max(f) - 1e-4


def test_blocked_fit_and_map_dispersion_on_spark(spark):
    """D5 and D7 through the jobs: prior, MAP dispersion, kept outliers, coefficients and Wald errors of any column."""
    design, s, Y, alpha = _study(8, 200, seed=5)
    D = G.blocked_design(design, ["patient", "condition"], "patient", {"condition": "n"})
    X, (m, p) = _dense(D), D.shape
    disp = cut_lineage(G.genewise_dispersion(_frame(spark, Y), D, list(s)))
    trend = {"a0": 0.05, "a1": 3.0, "n_genes": 200, "parametric": True}
    prior = G.dispersion_prior(disp, trend, m, p)
    rows = {r.gene_id: r for r in disp.collect()}
    res = np.array([math.log(r.alpha_gw) - math.log(0.05 + 3 / r.base_mean) for r in rows.values() if r.alpha_gw >= 1e-6])
    s_lr = 1.4826 * np.median(np.abs(res - np.median(res)))
    assert abs(prior["s_lr"] - s_lr) < 1e-9
    assert abs(prior["prior_var"] - max(s_lr ** 2 - trigamma((m - p) / 2), 0.25)) < 1e-9
    fit = cut_lineage(G.fit_genes(disp, D, list(s), trend, prior))
    got = {r.gene_id: r for r in fit.collect()}
    assert len(got) == 200
    names = {"t": "condition[T.t]", "p": "patient[T.p0003]"}
    c = {k: [float(n == v) for n in D.names] for k, v in names.items()}
    c["mix"] = (np.array(c["t"]) - 2 * np.array(c["p"]) + 0.5 * np.array([float(n == "patient[T.p0005]") for n in D.names])).tolist()
    w = {k: {r.gene_id: r for r in G.wald(fit, v, k, D.n_blocks).collect()} for k, v in c.items()}
    for i in range(0, 200, 5):
        g = f"g{i:04d}"
        r, tr = got[g], 0.05 + 3 / rows[g].base_mean
        mu0 = _dense_irls(Y[i], X, s, r.alpha_gw)[2]
        f = [_dense_objective(Y[i], mu0, X, x, tr, prior["prior_var"]) for x in np.linspace(math.log(1e-8), math.log(m), 250)]
        assert _dense_objective(Y[i], mu0, X, math.log(r.alpha_map), tr, prior["prior_var"]) >= max(f) - 1e-3
        kept = math.log(r.alpha_gw) > math.log(tr) + 2 * prior["s_lr"]
        assert r.alpha == (r.alpha_gw if kept else r.alpha_map) and abs(r.alpha_trend - tr) < 1e-12
        b, C, _ = _dense_irls(Y[i], X, s, r.alpha)
        assert np.allclose(r.beta, b, atol=1e-3)
        for k, v in c.items():
            v = np.array(v)
            assert abs(w[k][g].log2_fold_change - v @ b / math.log(2)) < 5e-3
            assert abs(w[k][g].lfc_se / (math.sqrt(v @ C @ v) / math.log(2)) - 1) < 1e-3


def test_thousand_patients(spark):
    """Time and memory go with the number of patients: 1,000 of them fit without a dense normal matrix."""
    design, s, Y, _ = _study(1000, 8, seed=9)
    D = G.blocked_design(design, ["patient", "condition"], "patient", {"condition": "n"})
    assert D.shape == (3000, 1002)
    t = time.monotonic()
    disp = cut_lineage(G.genewise_dispersion(_frame(spark, Y), D, list(s)))
    fit = G.fit_genes(disp, D, list(s), {"a0": 0.05, "a1": 3.0}, {"prior_var": 0.25, "s_lr": 1.0})
    rows = G.wald(fit, G.contrast_vector(D.names, "condition", "t", "n"), "t", D.n_blocks).collect()
    assert len(rows) == 8 and all(0 < r.lfc_se < 0.2 for r in rows) and time.monotonic() - t < 120


def test_confounded_blocks_raise():
    design = [{"patient": p, "condition": "n" if p < "c" else "t"} for p in "aabbccdd"]
    with pytest.raises(ValueError):
        G.blocked_design(design, ["patient", "condition"], "patient")
    with pytest.raises(ValueError):
        G.blocked_design(design, ["patient"], "patient", {"patient": "x"})


def _gamma_trend(x, a, fits=6):
    """The trend by iterated weighted least squares, refitted without genes far from it."""
    keep, last, b = np.ones(len(x), bool), None, None
    for _ in range(fits):
        X, y = np.column_stack([np.ones(keep.sum()), x[keep]]), a[keep]
        mu = np.maximum(y, 1e-12)
        for _ in range(200):
            new = np.linalg.solve(X.T @ (X / mu[:, None] ** 2), X.T @ (y / mu ** 2))
            mu = np.maximum(X @ new, 1e-12)
            if b is not None and np.abs(new - b).max() < 1e-13:
                break
            b = new
        if last is not None and np.abs(b - last).max() < 1e-6:
            break
        last = b
        ratio = a / (b[0] + b[1] * x)
        keep = (ratio >= 1e-4) & (ratio <= 15)
    return b, keep.sum()


def _trend_frame(spark, mean, a):
    return spark.createDataFrame(list(zip(mean.tolist(), a.tolist())), "base_mean double, alpha_gw double")


def test_trend_equals_a_numpy_gamma_fit_and_recovers_the_truth(spark):
    rng = np.random.default_rng(11)
    mean = np.exp(rng.uniform(1, 9, 4000))
    a = (0.05 + 3 / mean) * rng.gamma(4, 0.25, 4000)
    far = rng.permutation(4000)[:40]
    a[far] *= 500                                                            # left out by the refit
    t = G.dispersion_trend(_trend_frame(spark, mean, a))
    b, n = _gamma_trend(1 / mean, a)
    assert t["parametric"] and t["n_genes"] == n <= 3960
    assert abs(t["a0"] / b[0] - 1) < 1e-4 and abs(t["a1"] / b[1] - 1) < 1e-4
    assert abs(t["a0"] - 0.05) < 0.005 and abs(t["a1"] - 3) < 0.3


def test_trend_falls_back_to_the_mean(spark):
    rising = G.dispersion_trend(_trend_frame(spark, np.array([10.0, 100.0, 1000.0, 5000.0]), np.array([0.01, 0.1, 1.0, 4.0])))
    assert not rising["parametric"] and abs(rising["a0"] - 5.11 / 4) < 1e-12 and rising["a1"] == 0
    same = G.dispersion_trend(_trend_frame(spark, np.array([10.0, 10.0]), np.array([0.2, 0.4])))
    assert not same["parametric"] and abs(same["a0"] - 0.3) < 1e-12
    none = G.dispersion_trend(_trend_frame(spark, np.array([10.0]), np.array([0.2])).where(F.col("alpha_gw") > 1))
    assert not none["parametric"] and none["n_genes"] == 0 and math.isnan(none["a0"])


def test_settled_genes_leave_the_fit(monkeypatch):
    """Genes at their fixed point are not fitted again while slower ones go on; their results stay those of the whole run."""
    rng = np.random.default_rng(3)
    X = np.column_stack([np.ones(12), np.tile([0.0, 1.0], 6), np.arange(12) % 3 == 0, np.arange(12) / 12.0])
    Y = rng.negative_binomial(4, 0.05, size=(200, 12)).astype(float)
    Y[:3] = 0
    Y[:3, 5] = 4000                                                           # slow: one sample has all
    s, alpha, sizes, whole = np.exp(rng.normal(0, 0.3, 12)), np.full(200, 0.25), [], G.Normal

    class Counted(whole):
        def __init__(self, w, *a):
            sizes.append(len(w))
            super().__init__(w, *a)

    monkeypatch.setattr(G, "Normal", Counted)
    beta, _, mu, _ = G._irls_normal(Y, G.as_design(X), s, alpha)
    rounds = sizes[1:-1]
    assert len(rounds) > 6 and sum(rounds) < 0.8 * 200 * len(rounds)
    monkeypatch.setattr(G, "FIXED_POINT", -1.0)
    beta_all, _, mu_all, _ = G._irls_normal(Y, G.as_design(X), s, alpha)
    assert np.allclose(beta, beta_all, rtol=1e-9, atol=1e-11) and np.allclose(mu, mu_all, rtol=1e-9)


def test_gene_arrays_are_made_once(spark, tmp_path):
    """The arrays that the size factors and the model jobs read are a written table, and agree with the long form."""
    from conftest import SF001
    from helixframe.operators import normalize as N
    from helixframe.operators import reshape as R
    from helixframe.plans.pipeline import expression_inputs
    ctx = expression_inputs(spark, SF001)
    assert "Exchange" not in ctx.gene_vec._jdf.queryExecution().executedPlan().toString()
    long = {r.sample_id: r.size_factor for r in N.size_factors(ctx.counts, ctx.n_samples).collect()}
    assert np.allclose([long[r["sample_id"]] for r in ctx.design], ctx.sf_array, rtol=1e-12)
    want = {r.gene_id: r.y for r in R.gene_vectors(ctx.counts, ctx.samples, ctx.n_samples).collect()}
    assert {r.gene_id: r.y for r in ctx.gene_vec.collect()} == want
