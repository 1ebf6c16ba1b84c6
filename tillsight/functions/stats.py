"""Closed-form statistics as Column expressions.

Neither Spark SQL nor the oracle engine has ``erf``; the standard normal CDF
is computed from the everywhere-positive series

    erf(x) = 2/sqrt(pi) * exp(-x^2) * sum_{n>=0} t_n,
    t_0 = x,  t_n = t_{n-1} * 2 x^2 / (2n + 1)

folded with the ``aggregate`` higher-order function. All terms are positive,
so there is no cancellation; 300 terms reach double precision for |x| <= 8.
Beyond that erf is 1 to double precision.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ERF_TERMS = 300
ERF_CLAMP = 8.0
Z_95 = 1.96  # fixed value of the two-sided 95 % interval


def erf_nonneg(x: Column) -> Column:
    """erf for x >= 0 (callers pass an absolute value)."""
    x = x.cast("double")
    init = F.struct(x.alias("t"), x.alias("s"))
    folded = F.aggregate(
        F.sequence(F.lit(1), F.lit(ERF_TERMS)),
        init,
        lambda acc, n: F.struct(
            (acc["t"] * F.lit(2.0) * x * x / (F.lit(2.0) * n + F.lit(1.0))).alias("t"),
            (acc["s"] + acc["t"] * F.lit(2.0) * x * x / (F.lit(2.0) * n + F.lit(1.0))).alias("s"),
        ),
        lambda acc: acc["s"],
    )
    series = F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-x * x) * folded
    return F.when(x > F.lit(ERF_CLAMP), F.lit(1.0)).otherwise(series)


def normal_cdf(z: Column) -> Column:
    """Phi(z) = (1 + sign(z) * erf(|z| / sqrt 2)) / 2."""
    z = z.cast("double")
    e = erf_nonneg(F.abs(z) / F.lit(math.sqrt(2.0)))
    return F.lit(0.5) * (F.lit(1.0) + F.signum(z) * e)


def two_sided_p(z: Column) -> Column:
    """2 * (1 - Phi(|z|))."""
    return F.lit(2.0) * (F.lit(1.0) - normal_cdf(F.abs(z)))


def _nz(c: Column) -> Column:
    """NULL instead of a zero denominator (ANSI mode raises on x / 0)."""
    return F.nullif(c.cast("double"), F.lit(0.0))


def proportion(x: Column, n: Column) -> Column:
    return x.cast("double") / _nz(n)


def pooled_z(x1: Column, n1: Column, x2: Column, n2: Column) -> Column:
    """Two-proportion z statistic with pooled standard error, (p2 - p1) / se."""
    p1, p2 = proportion(x1, n1), proportion(x2, n2)
    pool = (x1 + x2).cast("double") / _nz(n1 + n2)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.lit(1.0) / _nz(n1) + F.lit(1.0) / _nz(n2)))
    return (p2 - p1) / _nz(se)


def unpooled_se(p1: Column, n1: Column, p2: Column, n2: Column) -> Column:
    return F.sqrt(p1 * (F.lit(1.0) - p1) / _nz(n1) + p2 * (F.lit(1.0) - p2) / _nz(n2))


def arm_half_width(p: Column, n: Column, z: float = Z_95) -> Column:
    return F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / _nz(n))
