"""Money, rounding and safe division.

Two rounding regimes exist in the source analyses:
  * SQL path: ROUND half away from zero, applied to exact decimals
    -> ``round_sql`` (Spark ``round`` on a decimal is HALF_UP).
  * pandas path: numpy rounds half to even on the scaled binary double
    (``rint(x * 10**d) / 10**d``) -> ``round_float_half_even``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY_TYPE = "decimal(12,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY_TYPE)


def round_sql(c: Column, digits: int) -> Column:
    """ROUND half away from zero on an exact decimal value."""
    return F.round(c, digits)


def mean_sql(df: DataFrame, column: str, digits: int) -> Column:
    """Mean of an exact decimal column, rounded once, half away from zero (an aggregate of ``df``).

    ``avg`` of a decimal rounds to its own scale first; here the sum and the count are divided as whole numbers."""
    kind = df.schema[column].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    total = (F.sum(column) * F.lit(10 ** scale)).cast("decimal(38,0)")
    by = (F.count(column) * F.lit(10 ** max(scale - digits, 0))).cast("decimal(38,0)")
    ups = F.lit(10 ** max(digits - scale, 0))
    whole = F.call_function("div", F.abs(total) * ups * F.lit(2) + by, F.nullif(by * F.lit(2), F.lit(0)))
    return (F.signum(total).cast("int") * whole).cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))


def round_float_half_even(c: Column, digits: int) -> Column:
    """numpy/pandas ``round``: half to even on the scaled double."""
    scale = float(10 ** digits)
    return F.rint(c.cast("double") * F.lit(scale)) / F.lit(scale)


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an error on a zero denominator."""
    return num / F.nullif(den, F.lit(0))


def to_double(c: Column) -> Column:
    return c.cast("double")


def clip(c: Column, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (greatest/least would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))
