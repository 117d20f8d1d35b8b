"""Upper tail probabilities, for the one result row of a hypothesis test."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

# executors get the functions themselves and need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_share(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    total = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = c if abs(c) > _TINY else _TINY
            step = d * c
            total *= step
        if abs(step - 1.0) < 1e-15:
            break
    return front * total / a


def gamma_tail(s: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below s + 1, fraction above."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - scale * total)
    b = x + 1.0 - s
    c, d = 1.0 / _TINY, 1.0 / b
    total = d
    for i in range(1, 10_000):
        step = -i * (i - s)
        b += 2.0
        d = 1.0 / (step * d + b)
        c = b + step / c
        total *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return scale * total


def t_tail(t: float, df: float) -> float:
    if df > 1e7:
        return normal_tail(t)
    share = 0.5 * beta_share(df / 2.0, 0.5, df / (df + t * t))
    return share if t >= 0 else 1.0 - share


def f_tail(f: float, d1: float, d2: float) -> float:
    return 1.0 if f <= 0 else beta_share(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_tail(x: float, df: float) -> float:
    return gamma_tail(df / 2.0, x / 2.0)


def rank_sum_tail(u: float, a: float, b: float) -> float:
    """Chance that U is at least u when all orders of a + b different values are alike.

    The number of orders with a given U comes from those of smaller groups: factor by
    factor, each a product and a quotient of whole-number series."""
    small, large = sorted((int(a), int(b)))
    ways = [1] + [0] * (small * large)
    for i in range(1, small + 1):
        for k in range(len(ways) - 1, large + i - 1, -1):
            ways[k] -= ways[k - large - i]
        for k in range(i, len(ways)):
            ways[k] += ways[k - i]
    return sum(ways[max(0, math.ceil(u)) :]) / math.comb(small + large, small)


def _column(fn, *columns):
    def over(*series: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if any(pd.isna(v) for v in row) else fn(*map(float, row))
                for row in zip(*series)
            ],
            dtype="float64",
        )

    if len(columns) == 1:
        def run(a: pd.Series) -> pd.Series:
            return over(a)
    elif len(columns) == 2:
        def run(a: pd.Series, b: pd.Series) -> pd.Series:
            return over(a, b)
    else:
        def run(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
            return over(a, b, c)
    return F.pandas_udf(run, "double")(*columns)


def p_normal(z, alternative: str):
    """p of a normal statistic: alternative is greater, less or two-sided."""
    side = {"greater": z, "less": -z, "two-sided": F.abs(z)}[alternative]
    return _column(normal_tail, side) * F.lit(2.0 if alternative == "two-sided" else 1.0)


def p_t(t, df, alternative: str):
    side = {"greater": t, "less": -t, "two-sided": F.abs(t)}[alternative]
    return _column(t_tail, side, df) * F.lit(2.0 if alternative == "two-sided" else 1.0)


def p_f(f, d1, d2):
    return _column(f_tail, f, d1, d2)


def p_chi2(x, df):
    return _column(chi2_tail, x, df)


def p_rank_sum(u, a, b, alternative: str):
    """Exact p of Mann-Whitney's U of the first group, for groups of a and b different values."""
    side = {"greater": u, "less": a * b - u, "two-sided": F.greatest(u, a * b - u)}[alternative]
    return F.least(_column(rank_sum_tail, side, a, b) * F.lit(2.0 if alternative == "two-sided" else 1.0), F.lit(1.0))
