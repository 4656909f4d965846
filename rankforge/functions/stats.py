"""Distribution functions as Arrow-batched pandas UDFs.

Used only on small per-experiment results (one row per experiment), never in
a hot path.  No scipy: the normal distribution comes from
``statistics.NormalDist`` and the Student-t tail from the continued fraction
of the regularised incomplete beta function (DLMF 8.17).
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_N = NormalDist()


def norm_cdf(x: float) -> float:
    return _N.cdf(x)


def norm_ppf(p: float) -> float:
    return _N.inv_cdf(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction 1 / (1 + d1 / (1 + d2 / ...)) of DLMF 8.17.22.

    Evaluated from its last term; the number of terms, which grows with the
    root of the parameters, is doubled until the value stands still.
    """
    def term(k: int) -> float:
        m, odd = divmod(k, 2)
        over = -(a + m) * (a + b + m) if odd else m * (b - m)
        return over * x / ((a + k - 1) * (a + k))

    def of(terms: int) -> float:
        value = 1.0
        for k in range(terms, 0, -1):
            value = 1.0 + term(k) / value
        return 1.0 / value

    terms, now = 16, of(16)
    while terms < 1 << 17:
        terms, before, now = 2 * terms, now, of(2 * terms)
        if abs(now - before) <= 1e-15 * abs(now):
            break
    return now


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) \
        + b * math.log1p(-x)
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _beta_fraction(a, b, x) / a
    return 1.0 - bt * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t with ``df`` degrees of freedom."""
    if t is None or df is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def sample_size(effect: float, power: float = 0.95, alpha: float = 0.05,
                two_sided: bool = True) -> int:
    """B1: ceil(2 * ((z_alpha + z_beta) / d)^2)."""
    za = norm_ppf(1 - alpha / 2) if two_sided else norm_ppf(1 - alpha)
    zb = norm_ppf(power)
    return int(math.ceil(2 * ((za + zb) / effect) ** 2))


def mann_whitney_p(u: float, n1: float, n2: float, tie_term: float) -> float:
    """Two-sided normal approximation with tie correction and continuity.

    ``tie_term`` = sum over tie groups of (t^3 - t).
    """
    n = n1 + n2
    mu = n1 * n2 / 2.0
    var = n1 * n2 / 12.0 * ((n + 1) - tie_term / (n * (n - 1)))
    if var <= 0:
        return 1.0
    z = (abs(u - mu) - 0.5) / math.sqrt(var)
    return min(1.0, 2.0 * (1.0 - norm_cdf(z)))


#: The exact distribution of U is used without ties, up to this smaller sample.
MW_EXACT = 8


def mann_whitney_counts(n1: int, n2: int, upto: int) -> np.ndarray:
    """How many of the orders of two samples give U = 0 .. ``upto``: the
    coefficients of the Gaussian binomial prod (1 - x^(n2 + i)) / (1 - x^i),
    i = 1 .. n1 (Mann and Whitney, 1947)."""
    counts = np.zeros(upto + 1)
    counts[0] = 1.0
    for i in range(1, n1 + 1):
        for start in range(min(i, upto + 1)):            # divide by 1 - x^i
            counts[start::i] = np.cumsum(counts[start::i])
        if n2 + i <= upto:                               # times 1 - x^(n2 + i)
            counts[n2 + i:] = counts[n2 + i:] - counts[:upto + 1 - n2 - i]
    return counts


def mann_whitney_exact(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p-value of U without ties: twice the smaller tail."""
    small, large = min(n1, n2), max(n1, n2)
    low = int(min(u, n1 * n2 - u))
    tail = float(mann_whitney_counts(small, large, low).sum())
    return min(1.0, 2.0 * tail / math.comb(small + large, small))


def mann_whitney_two_sided(u: float, n1: float, n2: float, tie_term: float) -> float:
    """Exact if one sample has at most ``MW_EXACT`` values and none are tied,
    else the normal approximation; undefined without values on both sides."""
    if n1 < 1 or n2 < 1:
        return float("nan")
    if tie_term == 0 and min(n1, n2) <= MW_EXACT:
        return mann_whitney_exact(u, int(n1), int(n2))
    return mann_whitney_p(u, n1, n2, tie_term)


# --- pandas UDFs ------------------------------------------------------------
@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(float(a), float(b)) if pd.notna(a) and pd.notna(b)
                      else np.nan for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def norm_cdf_udf(x: pd.Series) -> pd.Series:
    return pd.Series([norm_cdf(float(v)) if pd.notna(v) else np.nan for v in x],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def norm_ppf_udf(p: pd.Series) -> pd.Series:
    return pd.Series([norm_ppf(float(v)) if pd.notna(v) and 0 < v < 1 else np.nan for v in p],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def mann_whitney_p_udf(u: pd.Series, n1: pd.Series, n2: pd.Series,
                       ties: pd.Series) -> pd.Series:
    return pd.Series([mann_whitney_two_sided(float(a), float(b), float(c), float(d))
                      for a, b, c, d in zip(u, n1, n2, ties)], dtype="float64")
