"""Two-sided p-values of Student's t as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Steps of the continued fraction. Their number grows with the root of the degrees of freedom near t = 0 only,
# where the complement is taken; 200 suffice to 1e-12.
STEPS = 200
# The asymptotic series of log gamma, B(2k) / (2k (2k-1)).
_SERIES = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)


def log_gamma(x: Column) -> Column:
    """Natural logarithm of gamma for x > 0: shifted to x + 8, where the series holds to 1e-15."""
    shift = F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(1.0), lambda p, k: p * (x + k))
    y = x + 8.0
    series = sum((F.lit(c) / F.pow(y, F.lit(2.0 * k + 1)) for k, c in enumerate(_SERIES)), F.lit(0.0))
    return (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + series - F.log(shift)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, by the modified method of Lentz."""

    def kept(value: Column) -> Column:
        return F.when(F.abs(value) < 1e-300, F.lit(1e-300)).otherwise(value)

    def term(state: Column, factor: Column) -> Column:
        d = 1.0 / kept(1.0 + factor * state["d"])
        c = kept(1.0 + factor / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["f"] * d * c).alias("f"))

    def both(state: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return term(term(state, even), odd)

    d = 1.0 / kept(1.0 - (a + b) * x / (a + 1.0))
    first = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("f"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, both, lambda state: state["f"])


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function for 0 <= x <= 1."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1.0 - x))
    low = front * _fraction(a, b, x) / a
    high = 1.0 - front * _fraction(b, a, 1.0 - x) / b
    return F.when(x <= 0.0, F.lit(0.0)).when(x >= 1.0, F.lit(1.0)).when(x < (a + 1.0) / (a + b + 2.0), low).otherwise(high)


def two_sided_p(t: Column, degrees: Column) -> Column:
    """Probability of a t at least as far from 0; null without degrees of freedom or without t."""
    t, nu = t.cast("double"), degrees.cast("double")
    found = incomplete_beta(nu / 2.0, F.lit(0.5), nu / (nu + t * t))
    return F.when(nu > 0, found)
