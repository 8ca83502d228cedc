"""Student t tail and quantile for a handful of result rows.

Spark has no t distribution, and the inputs are the few contrasts of a fitted
model, so a vectorised Python function is enough here.
"""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 20000):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return total
    raise ArithmeticError(f"the beta fraction did not converge for a={a}, b={b}, x={x}")


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic."""
    if t != t or df != df or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    if df > 1e7:
        # the first terms of the expansion around the normal law; what is left out is of order
        # df^-2, below 1e-13, while the beta function loses nine digits to its large logarithms
        # here. The two meet within 1e-9 (tested)
        z = abs(t)
        density = math.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi)
        return math.erfc(z / math.sqrt(2.0)) + density * (z**3 + z) / (2.0 * df)
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(level: float, df: float) -> float:
    """Two-sided critical value: P(|T| > q) = 1 - level."""
    if df != df or df <= 0:
        return math.nan
    lo, hi = 0.0, 1.0
    while t_two_sided(hi, df) > 1.0 - level:
        lo, hi = hi, hi * 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_two_sided(mid, df) > 1.0 - level:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0
