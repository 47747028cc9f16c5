"""Negative-binomial GLM per gene (D3-D9, D11) as grouped Spark jobs.

Genes are the parallel axis. Each job is a ``mapInPandas`` over the
gene-array table (gene_id, y array<double>): one Arrow batch holds many
genes and the numpy code is vectorised across them (batched p x p
solves), with the design matrix and size factors (m scalars) shipped in
the closure. Nothing per gene comes back to the driver; the driver only
sees a handful of trend / prior scalars computed by Spark aggregates.

Formulas follow the published negative-binomial GLM method for count
data (median-of-ratios size factors, Cox-Reid adjusted dispersion,
parametric trend, log-normal dispersion prior, Wald test, Cook's distance).
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.mathx import f_quantile, lgamma_np, trigamma, two_sided_normal_p
from helixframe.operators.reshape import with_sample_array

MIN_DISP = 1e-8
MIN_MU = 0.5
RIDGE = 1e-6
MAX_IT = 50
FIXED_POINT = 1e-13         # a coefficient that moves less in a round has settled
GENES_AT_ONCE = 1_024
LN2 = math.log(2.0)


# ------------------------------------------------------------------ design

def design_matrix(design: list[dict], factors: list[str], ref: dict | None = None):
    """Treatment-coded model matrix: intercept + one column per non-reference level.

    Returns (X m x p, column names). Raises when X is rank deficient (a
    confounded design cannot be fitted).
    """
    ref = ref or {}
    cols, names = [np.ones(len(design))], ["Intercept"]
    for f in factors:
        levels = sorted({r[f] for r in design})
        base = ref.get(f, levels[0])
        if base not in levels:
            raise ValueError(f"reference level {base!r} not in {f}")
        for lv in levels:
            if lv == base:
                continue
            cols.append(np.array([1.0 if r[f] == lv else 0.0 for r in design]))
            names.append(f"{f}[T.{lv}]")
    X = np.column_stack(cols)
    if np.linalg.matrix_rank(X) < X.shape[1]:
        raise ValueError(f"design {factors} is rank deficient")
    return X, names


class Design:
    """A model matrix with one factor's columns kept as a block number per sample.

    ``A`` (m x q) holds the intercept and the columns of every other factor; sample j lies in block ``block[j]``
    of ``n_blocks`` + 1, block 0 being the reference level, which has no column. The normal matrix is then
    arrow-shaped (the blocks' part is diagonal), and everything a fit needs of it comes from the q x q Schur
    complement: time and memory grow with the number of blocks, not with its cube. A plain matrix is a design
    without blocks. Columns, coefficients and ``names`` are in the order of ``A``, then blocks.
    """

    def __init__(self, A: np.ndarray, block: np.ndarray | None = None, n_blocks: int = 0, names: list[str] | None = None):
        self.A = np.asarray(A, dtype=np.float64)
        self.block = np.zeros(len(self.A), dtype=np.int64) if block is None else np.asarray(block, dtype=np.int64)
        self.n_blocks, self.names = n_blocks, names or []
        # a few blocks: their sums as one matrix product
        self.member = (self.block[:, None] == np.arange(1, n_blocks + 1)).astype(np.float64) if 0 < n_blocks <= 32 else None
        self.cross = None if self.member is None else (self.member[:, :, None] * self.A[:, None, :]).reshape(len(self.A), -1)
        self.order = np.argsort(self.block, kind="stable")
        self.starts = np.searchsorted(self.block[self.order], np.arange(n_blocks + 1))
        if n_blocks and len(np.unique(self.block)) != n_blocks + 1:
            raise ValueError("a block without samples")

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.A), self.A.shape[1] + self.n_blocks

    def by_block(self, v: np.ndarray) -> np.ndarray:
        """Sums of the columns of ``v`` (G, m) over the samples of every block but the reference: (G, n_blocks)."""
        if not self.n_blocks:
            return np.zeros((len(v), 0))
        if self.member is not None:
            return v @ self.member
        return np.add.reduceat(v[:, self.order], self.starts, axis=1)[:, 1:]

    def full_rank(self) -> bool:
        """Whether all columns are independent: ``A`` less its mean over each block that has a column."""
        B = self.A.copy()
        for k in range(1, self.n_blocks + 1):
            i = self.order[self.starts[k]:self.starts[k + 1] if k < self.n_blocks else None]
            B[i] -= B[i].mean(axis=0)
        return np.linalg.matrix_rank(B) == self.A.shape[1]

    def cells(self) -> list[np.ndarray]:
        """Samples with the same row of the model matrix, cell by cell."""
        out: dict[tuple, list[int]] = {}
        for i, r in enumerate(self.A):
            out.setdefault((int(self.block[i]), *r), []).append(i)
        return [np.array(c) for c in out.values()]


def blocked_design(design: list[dict], factors: list[str], block: str, ref: dict | None = None) -> Design:
    """Treatment-coded design whose factor ``block`` (patients, batches; any number of levels) is eliminated
    by :class:`Design`. Raises when the columns are not independent."""
    ref = ref or {}
    A, names = design_matrix(design, [f for f in factors if f != block], ref)
    levels = sorted({r[block] for r in design})
    base = ref.get(block, levels[0])
    if base not in levels:
        raise ValueError(f"reference level {base!r} not in {block}")
    number = {lv: i for i, lv in enumerate([base] + [lv for lv in levels if lv != base])}
    out = Design(A, np.array([number[r[block]] for r in design]), len(levels) - 1,
                 names + [f"{block}[T.{lv}]" for lv in levels if lv != base])
    if not out.full_rank():
        raise ValueError(f"design {factors} is rank deficient")
    return out


def as_design(X) -> Design:
    return X if isinstance(X, Design) else Design(X)


# ------------------------------------------------------------------ numpy kernels

class Normal:
    """The normal matrix X'WX + ridge of a batch of genes, blocks eliminated: ``schur`` (G, q, q), ``inv``
    (G, n_blocks) one over the diagonal of the blocks, ``pull`` (G, n_blocks, q) the blocks' rows times ``inv``."""

    def __init__(self, w: np.ndarray, D: Design, ridge: float):
        q = D.A.shape[1]
        self.schur = _gram(w, D.A) + ridge * np.eye(q)[None]
        self.diag = D.by_block(w) + ridge
        self.inv = 1.0 / np.maximum(self.diag, 1e-300)
        self.pull = np.zeros((len(w), D.n_blocks, q))
        if D.n_blocks:
            rows = (np.stack([D.by_block(w * D.A[:, k]) for k in range(q)], axis=2) if D.cross is None
                    else (w @ D.cross).reshape(len(w), D.n_blocks, q))
            self.pull = rows * self.inv[:, :, None]
            self.schur = self.schur - np.einsum("gbk,gbl->gkl", rows, self.pull)

    def solve(self, D: Design, v: np.ndarray) -> np.ndarray:
        """Coefficients for the right-hand side X'v of every gene (v: G, m)."""
        vb = D.by_block(v)
        top = np.linalg.solve(self.schur, (v @ D.A - np.einsum("gb,gbk->gk", vb, self.pull))[..., None])[..., 0]
        return np.concatenate([top, vb * self.inv - np.einsum("gbk,gk->gb", self.pull, top)], axis=1)

    def logdet(self) -> np.ndarray:
        return _logdet(self.schur) + np.log(np.maximum(self.diag, 1e-300)).sum(axis=1)

    @staticmethod
    def logdet_of(w: np.ndarray, D: Design) -> np.ndarray:
        return Normal(w, D, 0.0).logdet()

    def leverage(self, D: Design, cov: np.ndarray) -> np.ndarray:
        """x_j' (X'WX)^-1 x_j of every gene and sample, ``cov`` being the inverse of ``schur``."""
        zero = np.zeros((len(cov), 1))
        u = D.A[None] - np.concatenate([np.zeros((len(cov), 1, D.A.shape[1])), self.pull], axis=1)[:, D.block]
        return np.einsum("gmk,gkl,gml->gm", u, cov, u, optimize=True) + np.concatenate([zero, self.inv], axis=1)[:, D.block]


def _predict(beta: np.ndarray, D: Design) -> np.ndarray:
    q = D.A.shape[1]
    eta = beta[:, :q] @ D.A.T
    return eta + np.concatenate([np.zeros((len(beta), 1)), beta[:, q:]], axis=1)[:, D.block] if D.n_blocks else eta


def _irls_normal(Y: np.ndarray, D: Design, s: np.ndarray, alpha: np.ndarray):
    """Batched IRLS: Y (G, m), s (m,), alpha (G,). Returns beta, the :class:`Normal` at the end, mu, converged."""
    logs = np.log(s)[None, :]
    # start: least squares on log normalised counts
    z0 = np.log((Y + 0.5) / s[None, :])
    beta = Normal(np.ones((1, Y.shape[1])), D, RIDGE).solve(D, z0)
    mean = lambda b: np.maximum(np.exp(np.clip(_predict(b, D) + logs, -30, 30)), MIN_MU)
    mu, conv = mean(beta), np.zeros(len(Y), bool)
    # genes still moving: the others stand at their fixed point, where a round gives the same coefficients again
    live, y, m, a, b = np.arange(len(Y)), Y, mu, alpha[:, None], beta
    fixed, dev_old = _nb_constant(Y, alpha), np.full(len(Y), np.inf)
    for _ in range(MAX_IT):
        w = m / (1.0 + a * m)
        b_old, b = b, Normal(w, D, RIDGE).solve(D, w * (np.log(m) - logs + (y - m) / m))
        m = mean(b)
        dev = -2.0 * (fixed + _nb_in_mu(y, m, a))
        still = np.abs(dev - dev_old) / (np.abs(dev) + 0.1) < 1e-8
        beta[live], mu[live], conv[live] = b, m, still
        if conv.all():
            break
        move = ~still | (np.abs(b - b_old).max(axis=1) > FIXED_POINT)
        dev_old = dev
        if not move.all():
            live, y, m, a, b, fixed, dev_old = live[move], y[move], m[move], a[move], b[move], fixed[move], dev[move]
    return beta, Normal(mu / (1.0 + alpha[:, None] * mu), D, RIDGE), mu, conv


def _irls(Y: np.ndarray, X, s: np.ndarray, alpha: np.ndarray):
    """As :func:`_irls_normal`, the second value being X'WX (of a blocked design: its Schur complement)."""
    beta, normal, mu, conv = _irls_normal(Y, as_design(X), s, alpha)
    return beta, normal.schur, mu, conv


def _gram(w: np.ndarray, X: np.ndarray) -> np.ndarray:
    """X' diag(w_g) X of every gene as one matrix product with the rows' outer products."""
    m, p = X.shape
    return (w @ (X[:, :, None] * X[:, None, :]).reshape(m, p * p)).reshape(-1, p, p)


def _nb_constant(Y, alpha):
    """The part of each gene's log-likelihood that no mean changes."""
    r = 1.0 / np.maximum(alpha, MIN_DISP)[:, None]
    return (lgamma_np(Y + r) - lgamma_np(r) - lgamma_np(Y + 1)).sum(axis=1)


def _nb_in_mu(Y, mu, a):
    """The rest of it, ``a`` (G, 1) being the dispersions."""
    a = np.maximum(a, MIN_DISP)
    am = a * mu
    return (Y * np.log(am) - (Y + 1.0 / a) * np.log1p(am)).sum(axis=1)


def _nb_loglik(Y, mu, alpha):
    return _nb_constant(Y, alpha) + _nb_in_mu(Y, mu, alpha[:, None])


def _logdet(S: np.ndarray) -> np.ndarray:
    """Log-determinants of positive definite matrices (G, q, q), eliminated column by column for all genes at once."""
    q = S.shape[1]
    if q > 8:
        return np.linalg.slogdet(S)[1]
    rows = [[S[:, i, j] for j in range(q)] for i in range(q)]
    det = np.zeros(len(S))
    for k in range(q):
        pivot = np.maximum(np.abs(rows[k][k]), 1e-300)
        det = det + np.log(pivot)
        for i in range(k + 1, q):
            f = rows[i][k] / pivot
            for j in range(k + 1, q):
                rows[i][j] = rows[i][j] - f * rows[k][j]
    return det


class CoxReid:
    """Cox-Reid adjusted profile log-likelihoods of a batch of genes, less the term in Y alone, which no alpha changes.
    What does not depend on alpha is computed once: sums over a gene's samples, the different counts of the batch."""

    def __init__(self, Y, mu, X):
        self.Y, self.mu, self.D, self.m = Y, mu, as_design(X), Y.shape[1]
        self.total, self.log_mu = Y.sum(axis=1), (Y * np.log(mu)).sum(axis=1)
        self.counts, self.place = np.unique(Y, return_inverse=True)
        self.place = self.place.reshape(Y.shape)

    def __call__(self, log_alpha):
        """At each gene's own log alpha (G,), or at one for all (a number)."""
        al = np.exp(log_alpha)
        a = np.maximum(al, MIN_DISP)
        r, ac = 1.0 / a, np.reshape(a, (-1, 1))
        gammas = lgamma_np(self.counts + r)[self.place] if np.ndim(a) == 0 else lgamma_np(self.Y + r[:, None])
        log1p = np.log1p(ac * self.mu)
        ll = (gammas - (self.Y + 1.0 / ac) * log1p).sum(axis=1) - self.m * lgamma_np(r) + self.log_mu + self.total * np.log(a)
        return ll - 0.5 * Normal.logdet_of(self.mu / (1.0 + np.reshape(al, (-1, 1)) * self.mu), self.D)


def _cr_loglik(Y, mu, X, log_alpha):
    return CoxReid(Y, mu, X)(log_alpha)


def _maximise(Y, mu, X, lo, hi, prior_mean=None, prior_var=None, coarse: int = 17, steps: int = 20):
    """Maximum of the (penalised) Cox-Reid likelihood in log alpha: a coarse grid brackets it, golden
    sections close in on all genes at once (to about 2e-4; 37 evaluations). More than GENES_AT_ONCE are taken in turn,
    so that the arrays of an evaluation stay in the processor's cache."""
    if len(Y) > GENES_AT_ONCE:
        X, at = as_design(X), lambda v, i: v[i:i + GENES_AT_ONCE] if np.ndim(v) else v
        return np.concatenate([_maximise(at(Y, i), at(mu, i), X, lo, hi, at(prior_mean, i), at(prior_var, i), coarse, steps)
                               for i in range(0, len(Y), GENES_AT_ONCE)])
    likelihood = CoxReid(Y, mu, X)

    def obj(la):
        v = likelihood(la)
        return v if prior_mean is None else v - (la - prior_mean) ** 2 / (2.0 * prior_var)

    grid = np.linspace(lo, hi, coarse)
    best = grid[np.argmax(np.stack([obj(x) for x in grid], axis=1), axis=1)]
    left, right = np.maximum(best - (grid[1] - grid[0]), lo), np.minimum(best + (grid[1] - grid[0]), hi)
    k = (math.sqrt(5) - 1) / 2
    x1, x2 = right - k * (right - left), left + k * (right - left)
    f1, f2 = obj(x1), obj(x2)
    for _ in range(steps - 2):
        up = f1 < f2
        left, right = np.where(up, x1, left), np.where(up, right, x2)
        new = np.where(up, left + k * (right - left), right - k * (right - left))
        fn = obj(new)
        x1, f1, x2, f2 = np.where(up, x2, new), np.where(up, f2, fn), np.where(up, new, x1), np.where(up, fn, f1)
    return np.exp(np.clip(np.where(f1 > f2, x1, x2), lo, hi))


def _stack(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


# ------------------------------------------------------------------ D3: gene-wise dispersion

def genewise_dispersion(gene_vec: DataFrame, X: np.ndarray | Design, sf: list[float]) -> DataFrame:
    """D3: (gene_id, y, base_mean, disp_moment, mu0 fit, alpha_gw) per gene.

    Start: moment estimate; mu from an IRLS fit at that value; then the
    Cox-Reid adjusted likelihood is maximised in log alpha over
    [log 1e-8, log max(10, m)]. Genes with all-zero counts get NULL.
    """
    X = as_design(X)
    s = np.asarray(sf, dtype=np.float64)
    m = len(s)
    inv_mean = float(np.mean(1.0 / s))
    hi = math.log(max(10.0, m))
    lo = math.log(MIN_DISP)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if pdf.empty:
                continue
            Y = _stack(pdf["y"])
            q = Y / s[None, :]
            bm = q.mean(axis=1)
            var = q.var(axis=1, ddof=1)
            ok = bm > 0
            mom = np.where(ok, np.maximum((var - bm * inv_mean) / np.where(ok, bm * bm, 1), MIN_DISP), np.nan)
            agw = np.full(len(Y), np.nan)
            if ok.any():
                Yk = Y[ok]
                _, _, mu, _ = _irls(Yk, X, s, np.minimum(mom[ok], math.exp(hi)))
                agw[ok] = _maximise(Yk, mu, X, lo, hi)
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "y": pdf["y"], "base_mean": bm,
                                "disp_moment": mom, "alpha_gw": agw})

    return gene_vec.select("gene_id", "y").mapInPandas(
        run, "gene_id string, y array<double>, base_mean double, disp_moment double, alpha_gw double")


# ------------------------------------------------------------------ D4: trend

def dispersion_trend(disp: DataFrame, max_fits: int = 6) -> dict:
    """Parametric trend alpha(mu) = a1 / mu + a0, a gamma GLM with identity link (Spark ML).

    At most ``max_fits`` fits: genes whose alpha lies outside [1e-4, 15] times the trend are left out and
    the rest is fitted again, until the coefficients settle to 1e-6. Falls back to the mean dispersion when a
    coefficient is not positive, when there is no gene to fit or when all have one base mean (no slope).
    Returns {a0, a1, n_genes, parametric}; without any gene a0 is NaN.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    from helixframe.session import cut_lineage
    base = disp.where((F.col("alpha_gw") >= 100 * MIN_DISP) & (F.col("base_mean") > 0)) \
        .select((F.lit(1.0) / F.col("base_mean")).alias("x"), F.col("alpha_gw").alias("a"))
    base = cut_lineage(VectorAssembler(inputCols=["x"], outputCol="features").transform(base))
    model = GeneralizedLinearRegression(family="gamma", link="identity", featuresCol="features", labelCol="a", tol=1e-9, maxIter=50)
    size = base.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("a").alias("mean")).first()
    flat = {"a0": float("nan") if size["mean"] is None else float(size["mean"]), "a1": 0.0, "n_genes": size["n"], "parametric": False}
    if not size["n"] or size["lo"] == size["hi"]:
        return flat
    cur, n, before = base, size["n"], None
    for _ in range(max_fits):
        fit = model.fit(cur)
        a0, a1 = float(fit.intercept), float(fit.coefficients[0])
        if not (a0 > 0 and a1 > 0 and math.isfinite(a0 + a1)):
            return flat
        if before and abs(before[0] - a0) < 1e-6 * max(1, a0) and abs(before[1] - a1) < 1e-6 * max(1, a1):
            break
        ratio = F.col("a") / (F.lit(a0) + F.lit(a1) * F.col("x"))
        cur, before = base.where((ratio >= 1e-4) & (ratio <= 15)), (a0, a1)
        kept, n = n, cur.count()
        if kept == n == size["n"]:
            break                                                            # nothing was left out: the fit stands
    return {"a0": a0, "a1": a1, "n_genes": n, "parametric": True}


def trend_col(trend: dict, base_mean="base_mean"):
    return F.lit(trend["a0"]) + F.lit(trend["a1"]) / F.col(base_mean)


# ------------------------------------------------------------------ D5: prior

def dispersion_prior(disp: DataFrame, trend: dict, m: int, p: int) -> dict:
    """Prior sd of log dispersion around the trend from the MAD of log
    residuals (two exact percentile aggregates) less the sampling variance
    trigamma((m - p) / 2); floored at 0.25."""
    r = disp.where(F.col("alpha_gw") >= 100 * MIN_DISP).select(
        (F.log("alpha_gw") - F.log(trend_col(trend))).alias("r"))
    from helixframe.operators.stats import exact_median
    med = exact_median(r, "r").first()[0]
    mad = exact_median(r.select(F.abs(F.col("r") - F.lit(med)).alias("d")), "d").first()[0]
    s_lr = 1.4826 * mad
    var = max(s_lr ** 2 - (trigamma((m - p) / 2.0) if m > p else 0.0), 0.25)
    return {"s_lr": s_lr, "prior_var": var}


# ------------------------------------------------------------------ D5-D8 fit

FIT_SCHEMA = ("gene_id string, base_mean double, alpha_gw double, alpha_trend double, alpha_map double, "
              "alpha double, beta array<double>, cov array<double>, block_inv array<double>, "
              "block_pull array<double>, converged boolean, "
              "max_cook double, n_cook_outliers int, n_replaced int")


#: Fixed values of the published trimmed-variance method: cells of at least so many replicates, share trimmed
#: at either end, factor that makes the trimmed variance unbiased for normal data.
TRIMMED_VARIANCE = ((24, 1 / 8, 1.51), (4, 1 / 4, 1.86), (1, 1 / 3, 2.04))
LEAST_ROBUST_DISPERSION = 0.04


def _trimmed_mean(a: np.ndarray, share: float) -> np.ndarray:
    k = int(a.shape[1] * share)
    return np.sort(a, axis=1)[:, k:a.shape[1] - k].mean(axis=1)


def robust_dispersion(q: np.ndarray, cells: list[np.ndarray], min_replicates: int = 3) -> np.ndarray:
    """Moment dispersion of each gene (rows of normalised counts) from the largest trimmed variance of the
    design cells with enough replicates (of all samples together if there is none)."""
    use = [c for c in cells if len(c) >= min_replicates] or [np.arange(q.shape[1])]
    v = np.zeros(len(q))
    for c in use:
        share, factor = next((t, f) for n, t, f in TRIMMED_VARIANCE if len(c) >= n)
        x = q[:, c]
        v = np.maximum(v, factor * _trimmed_mean((x - _trimmed_mean(x, share)[:, None]) ** 2, share))
    mean = np.maximum(q.mean(axis=1), 1e-8)
    return np.maximum((v - mean) / mean ** 2, LEAST_ROBUST_DISPERSION)


def fit_genes(disp: DataFrame, X: np.ndarray | Design, sf: list[float], trend: dict, prior: dict,
              cook_level: float = 0.99, min_replicates_replace: int = 7, min_replicates_cook: int = 3) -> DataFrame:
    """D5 MAP dispersion + D6/D7 IRLS fit + D8 Cook's distance, one pass per Arrow batch.

    * MAP alpha maximises CR-likelihood - (log a - log trend)^2 / (2 var);
      the gene-wise value is kept when it lies more than 2 s_lr above the trend.
    * Fit: IRLS with ridge 1e-6, mu floored at 0.5, eta clamped at +-30;
      covariance (X'WX)^-1; beta in natural-log units. Of a blocked design ``cov`` covers the columns
      before the blocks; ``block_inv`` and ``block_pull`` (row by row) give the rest, see :func:`wald`.
    * Cook's distance per sample, with a dispersion from trimmed cell variances, which a single
      outlier does not inflate; cutoff = F(p, m - p) quantile ``cook_level``.
      Samples in design cells with >= 7 replicates are replaced by
      s_j x (20 % trimmed mean of normalised counts), then the gene's dispersion and
      coefficients are fitted again; outliers in cells of 3-6 replicates are counted in
      ``n_cook_outliers`` (their p-values are set missing by :func:`wald`).
    """
    X = as_design(X)
    s = np.asarray(sf, dtype=np.float64)
    m, p = X.shape
    lo, hi = math.log(MIN_DISP), math.log(max(10.0, m))
    var, s_lr = prior["prior_var"], prior["s_lr"]
    cutoff = f_quantile(cook_level, p, m - p) if m > p else float("inf")
    # replicate count of each sample's design cell (identical model-matrix rows)
    cells = X.cells()
    reps = np.zeros(m, dtype=int)
    for c in cells:
        reps[c] = len(c)
    replace_ok = reps >= min_replicates_replace
    cook_ok = reps >= min_replicates_cook
    a0, a1 = trend["a0"], trend["a1"]

    def fit(Y, alpha):
        beta, normal, mu, conv = _irls_normal(Y, X, s, alpha)
        cov = np.linalg.inv(normal.schur)
        w = mu / (1.0 + alpha[:, None] * mu)
        h = w * normal.leverage(X, cov)
        robust = robust_dispersion(Y / s[None, :], cells, min_replicates_cook)[:, None]
        cook = (Y - mu) ** 2 / (mu + robust * mu ** 2) / p * h / np.maximum((1 - h) ** 2, 1e-12)
        return [beta, cov, normal.inv, normal.pull, conv, cook]

    def dispersion(Y, agw, atr):
        _, _, mu0, _ = _irls(Y, X, s, agw)
        amap = _maximise(Y, mu0, X, lo, hi, prior_mean=np.log(atr), prior_var=var)
        return amap, np.where(np.log(agw) > np.log(atr) + 2 * s_lr, agw, amap)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            pdf = pdf[pdf["alpha_gw"].notna()]
            if pdf.empty:
                continue
            Y = _stack(pdf["y"])
            bm = pdf["base_mean"].to_numpy()
            agw = pdf["alpha_gw"].to_numpy()
            atr = a0 + a1 / bm
            amap, alpha = dispersion(Y, agw, atr)
            beta, cov, inv, pull, conv, cook = fitted = fit(Y, alpha)
            out_mask = (cook > cutoff)
            n_out = (out_mask & (cook_ok & ~replace_ok)[None, :]).sum(axis=1)
            rep_mask = out_mask & replace_ok[None, :]
            n_rep = rep_mask.sum(axis=1)
            if n_rep.any():
                g = n_rep > 0
                q = Y[g] / s[None, :]
                k = int(math.floor(0.2 * m))
                qs = np.sort(q, axis=1)
                tmean = qs[:, k:m - k].mean(axis=1) if m - 2 * k > 0 else q.mean(axis=1)
                Yr = np.where(rep_mask[g], np.floor(tmean[:, None] * s[None, :]), Y[g])
                start = np.clip(agw[g], MIN_DISP, math.exp(hi))
                agw_r = _maximise(Yr, _irls(Yr, X, s, start)[2], X, lo, hi)
                amap[g], alpha[g] = dispersion(Yr, agw_r, atr[g])
                for whole, part in zip(fitted, fit(Yr, alpha[g])):
                    whole[g] = part
            max_cook = np.where(cook_ok[None, :], cook, 0.0).max(axis=1)
            yield pd.DataFrame({
                "gene_id": pdf["gene_id"].to_numpy(), "base_mean": bm, "alpha_gw": agw, "alpha_trend": atr,
                "alpha_map": amap, "alpha": alpha, "beta": list(beta), "cov": list(cov.reshape(len(Y), -1)),
                "block_inv": list(inv), "block_pull": list(pull.reshape(len(Y), -1)), "converged": conv, "max_cook": max_cook, "n_cook_outliers": n_out.astype(np.int32),
                "n_replaced": n_rep.astype(np.int32)})

    return disp.select("gene_id", "y", "base_mean", "alpha_gw").mapInPandas(run, FIT_SCHEMA)


# ------------------------------------------------------------------ D9

def contrast_vector(names: list[str], factor: str, level: str, ref: str) -> list[float]:
    """Contrast [factor, level, ref] on treatment coding; ref must be the coded reference
    or another level (then the difference of the two coefficients)."""
    c = [0.0] * len(names)
    lv, rf = f"{factor}[T.{level}]", f"{factor}[T.{ref}]"
    if lv in names:
        c[names.index(lv)] += 1.0
    if rf in names:
        c[names.index(rf)] -= 1.0
    if not any(c):
        raise ValueError(f"contrast {factor} {level} vs {ref} not estimable from {names}")
    return c


def wald(fit: DataFrame, c: list[float], contrast: str = "contrast", n_blocks: int = 0) -> DataFrame:
    """LFC = c'b / ln 2, SE = sqrt(c'Sc) / ln 2, z = LFC / SE, p = erfc(|z| / sqrt 2).

    Catalyst columns over the stored beta / covariance arrays (any contrast
    without a refit); only erfc runs in an Arrow-batched pandas UDF.
    Genes with a Cook's outlier in a 3-6 replicate cell get p = NULL. The last ``n_blocks`` entries of ``c``
    are a blocked design's; with u = c before them less ``block_pull``'c of them, the variance is
    u' cov u + sum(c_b^2 block_inv_b), so only the blocks that ``c`` names are read.
    """
    p = len(c) - n_blocks
    cb = sum((F.lit(c[i]) * F.col("beta")[i] for i in range(len(c)) if c[i]), F.lit(0.0))
    named = [b for b in range(n_blocks) if c[p + b]]
    u = [F.lit(c[i]) - sum((F.lit(c[p + b]) * F.col("block_pull")[b * p + i] for b in named), F.lit(0.0)) if named
         else F.lit(c[i]) for i in range(p)]
    used = [i for i in range(p) if c[i] or named]
    csc = sum((u[i] * u[j] * F.col("cov")[i * p + j] for i in used for j in used), F.lit(0.0)) \
        + sum((F.lit(c[p + b] ** 2) * F.col("block_inv")[b] for b in named), F.lit(0.0))
    se = F.sqrt(csc)
    out = fit.select(F.lit(contrast).alias("contrast"), "gene_id", "base_mean", (cb / F.lit(LN2)).alias("log2_fold_change"),
                     (se / F.lit(LN2)).alias("lfc_se"), (cb / se).alias("stat"), "n_cook_outliers")
    out = out.withColumn("pvalue", F.when(F.col("n_cook_outliers") == 0, two_sided_normal_p("stat")))
    return out.drop("n_cook_outliers")


# ------------------------------------------------------------------ D10 independent filtering

def independent_filter(res: DataFrame, alpha: float = 0.05, n_theta: int = 50) -> tuple[DataFrame, float]:
    """Choose a baseMean cut maximising BH rejections, padj NULL below it.

    The theta grid (n_theta quantiles of baseMean) comes from one
    distributed exact-quantile job. A gene counts for every theta up to its baseMean, so each
    distinct p carries an array of n_theta counts; the BH ranks of all thetas are prefix sums of those
    arrays over ranges of p, and the rejections at theta are the genes up to the largest p with
    p * m / rank < alpha. No gene is copied and no window holds all of them. Fewer than 10
    rejections everywhere -> no filter.
    """
    from helixframe.operators.results import bh_adjust, ranged
    from helixframe.operators.stats import exact_quantiles
    qs = [i / n_theta for i in range(n_theta)]
    thetas = [r["base_mean"] for r in exact_quantiles(res, "base_mean", qs).orderBy("q").collect()]
    if not thetas:
        return res.withColumn("padj", F.lit(None).cast("double")), 0.0
    passes = [F.count_if(F.col("base_mean") >= F.lit(float(t))).alias(f"c{i}") for i, t in enumerate(thetas)]
    cs = [f"c{i}" for i in range(len(thetas))]
    d = ranged(res.where(F.col("pvalue").isNotNull()).groupBy("pvalue").agg(*passes), ["pvalue"])
    # one row per p range, n_theta sums in each
    parts = d.groupBy("__part").agg(*[F.sum(c).alias(c) for c in cs]).orderBy("__part").collect()
    total = np.array([[r[c] for c in cs] for r in parts], float).reshape(len(parts), len(cs))
    before = np.cumsum(total, axis=0) - total
    m = total.sum(axis=0) if len(parts) else np.zeros(len(cs))
    if len(parts):
        spark = res.sparkSession
        off = spark.createDataFrame([(r["__part"], b.tolist()) for r, b in zip(parts, before)], "__part int, __off array<double>")
        w = Window.partitionBy("__part").orderBy("pvalue").rowsBetween(Window.unboundedPreceding, 0)
        ranks = d.join(F.broadcast(off), "__part").select("pvalue", *[(F.col("__off")[i] + F.sum(c).over(w)).alias(c) for i, c in enumerate(cs)])
        best = ranks.agg(*[F.max(F.when(F.col("pvalue") * F.lit(float(m[i])) < F.lit(alpha) * F.col(c), F.col(c))).alias(c)
                           for i, c in enumerate(cs)]).first()
        counts = [best[c] or 0 for c in cs]
    else:
        counts = [0] * len(cs)
    best_theta = float(thetas[int(np.argmax(counts))]) if max(counts) >= 10 else float(thetas[0])
    low = (F.col("base_mean") < best_theta) | F.col("pvalue").isNull()
    kept = bh_adjust(res.withColumn("__p", F.when(~low, F.col("pvalue"))), "__p", None, "padj")
    return kept.drop("__p"), best_theta


# ------------------------------------------------------------------ D11

def shrink_lfc(res: DataFrame) -> tuple[DataFrame, float]:
    """Heavy-tailed (Cauchy) prior MAP of the log2 fold change per gene.

    Likelihood of each gene's LFC approximated by N(lfc_hat, se^2); prior
    scale S from one aggregate over all genes (method of moments,
    S^2 = max(mean(lfc^2 - se^2), 1e-4)). The mode solves the cubic
    b^3 - b_hat b^2 + (S^2 + 2 se^2) b - b_hat S^2 = 0, whose real roots all lie between 0 and b_hat;
    they are written in closed form as Catalyst columns and the one with the least objective
    (b - b_hat)^2 / (2 se^2) + ln(S^2 + b^2) is the result.
    """
    r = res.where(F.col("log2_fold_change").isNotNull() & (F.col("lfc_se") > 0))
    s2 = r.agg(F.avg(F.col("log2_fold_change") ** 2 - F.col("lfc_se") ** 2)).first()[0]
    S2 = max(float(s2 or 0.0), 1e-4)
    out = cauchy_mode(res, "log2_fold_change", "lfc_se", S2, "lfc_shrunk")
    v, b2 = F.col("lfc_se") ** 2, F.col("lfc_shrunk") ** 2
    post = F.lit(1.0) / v + F.lit(2.0) * (F.lit(S2) - b2) / ((F.lit(S2) + b2) ** 2)
    out = out.withColumn("lfc_shrunk_se", F.when(post > 0, F.lit(1.0) / F.sqrt(post)))
    return out, math.sqrt(S2)


def cauchy_mode(df: DataFrame, lfc: str, se: str, S2: float, out: str) -> DataFrame:
    """``df`` with the posterior mode of each effect in ``out``: normal likelihood (lfc, se), Cauchy prior of
    squared scale ``S2``; null where the error is not positive. Column by column, so that no expression repeats another."""
    bh, v, p, q, disc = (F.col(f"__{x}") for x in ("bh", "v", "p", "q", "disc"))
    third = bh / 3
    d = df.withColumns({"__bh": F.abs(F.col(lfc)), "__v": F.col(se) * F.col(se)})
    # depressed cubic t^3 + p t + q, b = t + b_hat / 3
    d = d.withColumns({"__p": F.lit(S2) + 2 * v - bh * bh / 3, "__q": -2 * third ** 3 + third * (F.lit(S2) + 2 * v) - bh * F.lit(S2)})
    d = d.withColumn("__disc", (q / 2) ** 2 + (p / 3) ** 3)
    # one real root: of the two cube roots take the one without cancellation; the other is -p / 3 over it
    big = F.cbrt(F.abs(q) / 2 + F.sqrt(F.greatest(disc, F.lit(0.0)))) * F.when(q > 0, -1.0).otherwise(1.0)
    radius = 2 * F.sqrt(F.greatest(-p / 3, F.lit(0.0)))
    d = d.withColumns({"__big": big, "__radius": radius})
    cosine = F.when(F.col("__radius") > 0, 3 * q / (p * F.col("__radius"))).otherwise(F.lit(0.0))
    d = d.withColumn("__angle", F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))) / 3)
    single = F.when(F.col("__big") == 0, F.lit(0.0)).otherwise(F.col("__big") - p / (3 * F.col("__big")))
    for k in range(3):
        t = F.when(disc >= 0, single).otherwise(F.col("__radius") * F.cos(F.col("__angle") - F.lit(2 * math.pi * k / 3)))
        d = d.withColumn(f"__b{k}", F.greatest(F.least(t + third, bh), F.lit(0.0)))
    for k in range(3):
        b = F.col(f"__b{k}")
        d = d.withColumn(f"__c{k}", (b - bh) ** 2 / (2 * v) + F.ln(F.lit(S2) + b * b))
    best = F.array_min(F.array(*[F.struct(F.col(f"__c{k}").alias("c"), F.col(f"__b{k}").alias("b")) for k in range(3)]))["b"]
    return d.withColumn(out, F.when(F.col(se) > 0, F.signum(lfc) * best)).select(*df.columns, out)


def shrink_coefficient(fit: DataFrame, names: list[str], coefficient: str) -> tuple[DataFrame, float]:
    """D11 by the name of a model coefficient (``condition[T.tumor]``): its Wald table, shrunk."""
    if coefficient not in names:
        raise ValueError(f"no coefficient {coefficient!r} among {names}")
    return shrink_lfc(wald(fit, [float(n == coefficient) for n in names], coefficient))


# ------------------------------------------------------------------ D6 without Python

def fit_single_factor(gene_vec: DataFrame, design: list[dict], factor: str, ref: str, sf: list[float],
                      alpha_col: str = "alpha", n_iter: int = 30) -> DataFrame:
    """D6 as Catalyst expressions only: one-factor NB fit in cell-means form.

    For each level L the MLE solves sum_{j in L} (y_j - mu_j) / (1 + a mu_j) = 0
    with mu_j = s_j exp(b_L) (floored at 0.5); Newton steps
    b += sum (y - mu)/(1 + a mu) / sum mu/(1 + a mu) run as an ``aggregate``
    over a step sequence on the gene's own array slice (JVM only, no Arrow
    round trip). Returns the same (beta, cov) arrays as :func:`fit_genes` in
    treatment coding (intercept = reference level), so :func:`wald` applies.
    """
    levels = sorted({r[factor] for r in design})
    if ref not in levels:
        raise ValueError(f"reference level {ref!r} not in {factor}")
    order = [ref] + [lv for lv in levels if lv != ref]
    a = F.col(alpha_col)
    zero = F.lit(0.0)
    per_sample = [(float(s), order.index(r[factor])) for s, r in zip(sf, design, strict=True)]
    out = with_sample_array(gene_vec.select("gene_id", alpha_col, "y"), "__d", per_sample, "array<struct<s: double, level: int>>")
    samples = F.zip_with("y", "__d", lambda y, d: F.struct(y.alias("y"), d["s"].alias("s"), d["level"].alias("level")))

    def mu(c, b):
        return F.greatest(c["s"] * F.exp(b), F.lit(MIN_MU))

    def level_fit(k):
        own = F.col(f"__c{k}")
        tot_y = F.aggregate(own, zero, lambda acc, c: acc + c["y"])
        b0 = F.log(F.greatest(tot_y, F.lit(0.5)) / F.aggregate(own, zero, lambda acc, c: acc + c["s"]))

        def step(b, _):
            num = F.aggregate(own, zero, lambda acc, c: acc + (c["y"] - mu(c, b)) / (F.lit(1.0) + a * mu(c, b)))
            den = F.aggregate(own, zero, lambda acc, c: acc + mu(c, b) / (F.lit(1.0) + a * mu(c, b)))
            return F.least(F.greatest(b + num / den, F.lit(-30.0)), F.lit(30.0))

        return F.aggregate(F.sequence(F.lit(1), F.lit(n_iter)), b0, step)

    out = out.select("gene_id", alpha_col, samples.alias("__cells"))
    out = out.select("gene_id", alpha_col, *[F.filter("__cells", lambda c: c["level"] == F.lit(k)).alias(f"__c{k}") for k in range(len(order))])
    out = out.select("*", *[level_fit(k).alias(f"__b{k}") for k in range(len(order))])

    def information(k):
        b = F.col(f"__b{k}")
        return F.aggregate(f"__c{k}", zero, lambda acc, c: acc + mu(c, b) / (F.lit(1.0) + a * mu(c, b)))

    vs = [F.lit(1.0) / information(k) for k in range(len(order))]
    p = len(order)
    beta = F.array(F.col("__b0"), *[F.col(f"__b{k}") - F.col("__b0") for k in range(1, p)])
    # treatment-coded covariance from independent cell means: var(int) = v0,
    # var(c_k) = v_k + v0, cov(int, c_k) = -v0, cov(c_k, c_l) = v0
    cells = []
    for i in range(p):
        for j in range(p):
            if i == 0 and j == 0:
                cells.append(vs[0])
            elif i == 0 or j == 0:
                cells.append(-vs[0])
            elif i == j:
                cells.append(vs[i] + vs[0])
            else:
                cells.append(vs[0])
    return out.select("gene_id", beta.alias("beta"), F.array(*cells).alias("cov"))
