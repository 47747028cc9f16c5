"""Special functions Spark lacks, as Column expressions or Arrow-batched UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_HALF_LOG_2PI = 0.5 * math.log(2.0 * math.pi)
_SHIFT = 10


def lgamma(x) -> Column:
    """log Gamma(x) for x > 0 as a Catalyst expression (stays in codegen).

    Arguments below 10 are shifted up by the recurrence
    ``lgamma(x) = lgamma(x + 10) - ln(x (x+1) ... (x+9))``; at x >= 10 the
    Stirling series with terms to x^-7 is accurate to ~1e-15 relative.
    """
    x = F.col(x) if isinstance(x, str) else x
    small = x < _SHIFT
    prod = F.lit(0.0)
    for j in range(_SHIFT):
        prod = prod + F.log(x + F.lit(float(j)))
    z = F.when(small, x + F.lit(float(_SHIFT))).otherwise(x)
    inv = F.lit(1.0) / z
    inv2 = inv * inv
    series = inv * (F.lit(1 / 12) - inv2 * (F.lit(1 / 360) - inv2 * (F.lit(1 / 1260) - inv2 * F.lit(1 / 1680))))
    st = (z - F.lit(0.5)) * F.log(z) - z + F.lit(_HALF_LOG_2PI) + series
    return F.when(small, st - prod).otherwise(st)


def log_choose(n, k) -> Column:
    """ln C(n, k) for 0 <= k <= n."""
    n = F.col(n) if isinstance(n, str) else n
    k = F.col(k) if isinstance(k, str) else k
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


@F.pandas_udf(DoubleType())  # a type object: importable on workers without a session
def erfc(x: pd.Series) -> pd.Series:
    """Complementary error function, element-wise over an Arrow batch (NULL stays NULL)."""
    out = pd.Series(np.nan, index=x.index, dtype="float64")
    m = x.notna()
    if m.any():
        out[m] = np.array([math.erfc(v) for v in x[m].to_numpy(dtype=np.float64)], dtype=np.float64)
    return out


def two_sided_normal_p(z) -> Column:
    """p = erfc(|z| / sqrt 2)."""
    z = F.col(z) if isinstance(z, str) else z
    return erfc(F.abs(z) / F.lit(math.sqrt(2.0)))


# ---------------------------------------------------------------- driver-side scalars

def lgamma_np(x: np.ndarray) -> np.ndarray:
    """Vectorised log Gamma for x > 0 (numpy has none; same series as :func:`lgamma`)."""
    x = np.asarray(x, dtype=np.float64)
    small = x < _SHIFT
    prod, z = 0.0, x
    if small.any():
        # x (x + 1) ... (x + 9) in pairs from both ends, below 4e11: one logarithm for the ten factors
        low = np.where(small, x, 1.0)
        t = low * (low + 9)
        prod = np.where(small, np.log(t * (t + 8) * (t + 14) * (t + 18) * (t + 20)), 0.0)
        z = np.where(small, x + _SHIFT, x)
    inv = 1.0 / z
    inv2 = inv * inv
    series = inv * (1 / 12 - inv2 * (1 / 360 - inv2 * (1 / 1260 - inv2 / 1680)))
    st = (z - 0.5) * np.log(z) - z + _HALF_LOG_2PI + series
    return st - prod


def trigamma(x: float) -> float:
    """psi_1(x) by recurrence + asymptotic series."""
    acc = 0.0
    while x < 12:
        acc += 1.0 / (x * x)
        x += 1.0
    inv = 1.0 / x
    inv2 = inv * inv
    return acc + inv + inv2 / 2 + inv * inv2 * (1 / 6 - inv2 * (1 / 30 - inv2 * (1 / 42 - inv2 / 30)))


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, 300):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c
        c = c if abs(c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c
        c = c if abs(c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-14:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def f_cdf(x: float, d1: float, d2: float) -> float:
    return betainc(d1 / 2, d2 / 2, d1 * x / (d1 * x + d2)) if x > 0 else 0.0


def f_quantile(q: float, d1: float, d2: float) -> float:
    """Quantile of the F(d1, d2) distribution by bisection on the CDF."""
    lo, hi = 0.0, 1.0
    while f_cdf(hi, d1, d2) < q:
        hi *= 2
        if hi > 1e12:
            break
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if f_cdf(mid, d1, d2) < q:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)
