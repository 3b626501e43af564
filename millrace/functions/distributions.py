"""Tail probabilities for the few numbers of a finished test statistic.

Spark SQL has no t or chi-square distribution. These run on the driver on one summary
row per test, never on table data.
"""

from __future__ import annotations

import math

_TINY = 1e-300
_EPS = 1e-16
_NORMAL_DF = 1e8


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    out = d
    for m in range(1, 100_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + num / c
            c = c if abs(c) > _TINY else _TINY
            out *= c * d
        if abs(c * d - 1.0) < _EPS * 10:
            break
    return out


def beta_regularized(a: float, b: float, x: float) -> float:
    """I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    if df >= _NORMAL_DF:  # the two distributions agree to 1e-9 from here on
        return math.erfc(abs(t) / math.sqrt(2.0))
    t2 = t * t
    if t2 < df:  # keeps precision when df/(df+t2) is close to 1
        return 1.0 - beta_regularized(0.5, df / 2.0, t2 / (df + t2))
    return beta_regularized(df / 2.0, 0.5, df / (df + t2))


def gamma_upper(a: float, x: float) -> float:
    """Q(a, x), the regularized upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = out = 1.0 / a
        k = a
        while abs(term) > abs(out) * _EPS:
            k += 1.0
            term *= x / k
            out += term
        return 1.0 - front * out
    b = x + 1.0 - a
    c, d = 1.0 / _TINY, 1.0 / b
    out = d
    for i in range(1, 100_000):
        num = -i * (i - a)
        b += 2.0
        d = num * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + num / c
        c = c if abs(c) > _TINY else _TINY
        out *= c * d
        if abs(c * d - 1.0) < _EPS * 10:
            break
    return front * out


def chi2_upper(x: float, dof: int) -> float:
    """P(X >= x) for the chi-square distribution; 1 when there is no freedom."""
    return 1.0 if dof <= 0 else gamma_upper(dof / 2.0, x / 2.0)
