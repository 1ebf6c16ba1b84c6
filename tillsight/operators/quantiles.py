"""Exact quantiles (linear interpolation) and quantile-bin scores.

Semantics follow the linear method: for n sorted values x_0..x_{n-1} and
probability p, h = (n - 1) p, a = x_floor(h), b = x_floor(h)+1, t = h - floor(h),
value = b - (b - a)(1 - t) if t >= 0.5 else a + (b - a) t.

Bins are right-closed with the lowest edge included: a value equal to an inner
edge falls in the lower bin. Duplicate edges leave a bin empty (they are not an
error here).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.selection import order_statistics

QUARTILES = (0.25, 0.5, 0.75)


def _lerp(a: Column, b: Column, t: Column) -> Column:
    return F.when(t >= F.lit(0.5), b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float] = QUARTILES,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row ``edges: array<double>`` with the exact quantiles of ``value``, any cardinality (NULLs without rows).

    Only the rows at the interpolation positions are looked for (``order_statistics``):
    no sort of the table and no written copy. ``tiebreak`` (e.g. the row key) only
    helps to split a value that a large share of rows has.
    """
    vals = df.select(F.col(value).cast("double").alias("_q_v"), *tiebreak).where(F.col("_q_v").isNotNull())
    n = vals.count()
    spots = []
    for p in probs:
        h = (n - 1) * float(p)
        spots.append((math.floor(h) + 1, min(math.floor(h) + 2, n), h - math.floor(h)))
    found = order_statistics(vals, ["_q_v", *tiebreak], [i for lo, hi, _ in spots for i in (lo, hi)])
    at = {i: F.lit(float(k["_q_v"])) for i, k in found.items()}
    none = F.lit(None).cast("double")
    return df.sparkSession.range(1).select(F.array(*[
        _lerp(at.get(lo, none), at.get(hi, none), F.lit(t)) for lo, hi, t in spots]).alias("edges"))


def discrete_quantiles(df: DataFrame, value: str, probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact quantiles for a column with a bounded number of distinct values
    (days, counts): Spark's ``percentile`` keeps a value -> count map, merged
    after a partial aggregation. Equal to ``exact_quantiles`` on integer data.
    """
    spec = F.array(*[F.lit(float(p)) for p in probs])
    return df.agg(F.percentile(F.col(value).cast("double"), spec).alias("edges"))


def rank_quantile_edges(n: Column, probs: Sequence[float] = QUARTILES) -> Column:
    """Quantiles of the ranks 1..n: the linear method gives 1 + (n - 1) p exactly."""
    return F.array(*[F.lit(1.0) + (n - F.lit(1)).cast("double") * F.lit(float(p)) for p in probs])


def bin_score(x: Column, inner_edges: Column, descending: bool = False, bins: int = 4) -> Column:
    """1-based bin of x for right-closed bins; ``descending`` flips the labels.

    ``inner_edges`` holds the bins - 1 inner edges (it may be a scalar subquery,
    so it is indexed directly rather than folded by a higher-order function).
    """
    xd = x.cast("double")
    above = [F.when(xd > inner_edges.getItem(i), 1).otherwise(0) for i in range(bins - 1)]
    score = F.lit(1)
    for a in above:
        score = score + a
    return (F.lit(bins + 1) - score) if descending else score
