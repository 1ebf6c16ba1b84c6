"""Share of total and share of maximum.

``share_of_total`` / ``share_of_max`` take the total (or maximum) as a global
aggregate run as a scalar subquery: partial aggregation on every task, one
value back, no single-partition window; right for inputs of any size.

``*_bounded`` variants use a window over the whole input instead: the input is
read once, but all of it meets in one task, so they are only for inputs whose
size is bounded by construction (segments, region x channel cells).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, value: str, scale: float = 100.0) -> Column:
    total = df.select(F.sum(F.col(value)).cast("double")).scalar()
    return F.col(value).cast("double") / F.nullif(total, F.lit(0.0)) * F.lit(scale)


def share_of_max(df: DataFrame, value: str, scale: float = 1.0) -> Column:
    top = df.select(F.max(F.col(value)).cast("double")).scalar()
    return F.col(value).cast("double") / F.nullif(top, F.lit(0.0)) * F.lit(scale)


def share_of_total_bounded(value: str, scale: float = 100.0) -> Column:
    total = F.sum(F.col(value)).over(Window.partitionBy()).cast("double")
    return F.col(value).cast("double") / F.nullif(total, F.lit(0.0)) * F.lit(scale)


def share_of_max_bounded(value: str, scale: float = 1.0) -> Column:
    top = F.max(F.col(value)).over(Window.partitionBy()).cast("double")
    return F.col(value).cast("double") / F.nullif(top, F.lit(0.0)) * F.lit(scale)
