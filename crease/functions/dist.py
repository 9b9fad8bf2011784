"""Tail probabilities of the t, F and chi-square distributions, for turning one
test statistic into a p-value (SciPy is not available).

The incomplete beta and gamma functions come from their published continued
fractions, evaluated by the recurrence of numerators and denominators.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable

_CLOSE = 1e-15
_TERMS = 5_000
_LARGE = 1e200


def _fraction(terms: Iterable[tuple[float, float]]) -> float:
    """Value of ``a1 / (b1 + a2 / (b2 + ...))`` from its (a, b) pairs: numerators
    and denominators of the convergents follow one linear recurrence."""
    above, below, value = (1.0, 0.0), (0.0, 1.0), 0.0
    for a, b in itertools.islice(terms, _TERMS):
        above = above[1], b * above[1] + a * above[0]
        below = below[1], b * below[1] + a * below[0]
        if abs(below[1]) > _LARGE or abs(above[1]) > _LARGE:
            above, below = tuple(x / _LARGE for x in above), tuple(x / _LARGE for x in below)
        if below[1]:
            before, value = value, above[1] / below[1]
            if abs(value - before) <= _CLOSE * abs(value):
                break
    return value


def _beta_terms(a: float, b: float, x: float):
    yield 1.0, 1.0
    for m in itertools.count():
        yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        yield (m + 1) * (b - m - 1) * x / ((a + 2 * m + 1) * (a + 2 * m + 2)), 1.0


def _gamma_terms(a: float, x: float):
    yield 1.0, x + 1 - a
    for k in itertools.count(1):
        yield k * (a - k), x + 2 * k + 1 - a


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if not 0.0 < x < 1.0:
        return float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):  # the fraction converges fast on the other side only
        return 1.0 - betainc(b, a, 1.0 - x)
    scale = a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a + 1) - math.lgamma(b)
    return math.exp(scale) * _fraction(_beta_terms(a, b, x))


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    scale = a * math.log(x) - x
    if x > a + 1:
        return math.exp(scale - math.lgamma(a)) * _fraction(_gamma_terms(a, x))
    ratios = itertools.accumulate((x / (a + k) for k in range(1, _TERMS)), lambda p, r: p * r, initial=1.0)
    lower = math.fsum(itertools.takewhile(lambda t: t > _CLOSE / 10, ratios))
    return max(0.0, 1.0 - math.exp(scale - math.lgamma(a + 1)) * lower)


def t_two_sided_p(t: float, df: float) -> float:
    if df <= 0 or t is None or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_upper_p(f: float, d1: float, d2: float) -> float:
    if d1 <= 0 or d2 <= 0 or f is None or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_upper_p(x: float, k: float) -> float:
    if k <= 0 or x is None or math.isnan(x):
        return float("nan")
    return gammainc_upper(k / 2.0, x / 2.0)


def corr_p(r: float, n: int) -> float:
    """Two-sided p of a correlation coefficient (t with n - 2 df)."""
    if r is None or n < 3 or math.isnan(r):
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    t = r * math.sqrt((n - 2) / (1.0 - r * r))
    return t_two_sided_p(t, n - 2)
