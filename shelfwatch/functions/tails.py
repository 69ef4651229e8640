"""Upper tails of the Kolmogorov and chi-squared distributions, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Stirling's series for the logarithm of the gamma function.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
_SHIFT = 10
_TERMS = 12
_TINY = 1e-300


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function of a number above 0, to about 1e-13."""
    below = F.lit(0.0)
    for i in range(_SHIFT):
        below = below + F.log(a + i)
    z = a + float(_SHIFT)
    series = F.lit(0.0)
    for i, c in enumerate(_STIRLING):
        series = series + c / F.pow(z, F.lit(2.0 * i + 1))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - below


def gamma_upper(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x).

    Below ``a + 1`` the power series of its counterpart converges, above it the continued
    fraction. Both need about ``sqrt(a)`` terms, so the number of steps follows ``a``.
    """
    steps = F.sequence(F.lit(1), (150 + 12 * F.sqrt(a)).cast("int"))
    front = F.exp(a * F.log(x) - x - log_gamma(a))

    def grow(state: Column, i: Column) -> Column:
        term = state["term"] * x / (a + i)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    first = F.struct((1 / a).alias("term"), (1 / a).alias("total"))
    lower = front * F.aggregate(steps, first, grow, lambda state: state["total"])

    def guarded(value: Column) -> Column:
        return F.when(F.abs(value) < _TINY, F.lit(_TINY)).otherwise(value)

    def fraction(state: Column, i: Column) -> Column:
        over = (a - i) * i
        under = x + 1 - a + 2 * i
        d = 1 / guarded(over * state["d"] + under)
        c = guarded(under + over / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * d * c).alias("h"))

    start = 1 / guarded(x + 1 - a)
    begin = F.struct(F.lit(1 / _TINY).alias("c"), start.alias("d"), start.alias("h"))
    upper = front * F.aggregate(steps, begin, fraction, lambda state: state["h"])
    return F.when(x <= 0, 1.0).when(x < a + 1, 1 - lower).otherwise(upper)


def chi2_tail(chi2: Column, degrees: Column) -> Column:
    """Chance of a chi-squared value at least so large; 1 where there are no degrees of freedom."""
    a, x = degrees.cast("double") / 2, chi2.cast("double") / 2
    return F.when(degrees > 0, gamma_upper(F.greatest(a, F.lit(0.5)), x)).when(degrees == 0, 1.0)


def kolmogorov_tail(gap: Column, n: Column, m: Column) -> Column:
    """Chance of a gap at least so wide between the distributions of two samples of sizes n and m.

    The limit of large samples. Of its two series the one that converges fast is summed.
    """
    size = n.cast("double") * m / (n + m)
    at = gap * F.sqrt(size)
    far, near = F.lit(0.0), F.lit(0.0)
    for k in range(1, _TERMS + 1):
        far = far + (2.0 if k % 2 else -2.0) * F.exp(-2.0 * k * k * at * at)
        near = near + F.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * at * at))
    near = 1 - math.sqrt(2 * math.pi) / at * near
    tail = F.when(at <= 0.05, 1.0).when(at < 1, near).otherwise(far)
    return F.when((n > 0) & (m > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))
