"""Calendar gap filling (a monthly resample with zeros)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_month_gaps(df: DataFrame, month_col: str, value_cols: Sequence[str],
                    group_cols: Sequence[str] = (), fill_value=0) -> DataFrame:
    """Add a row with ``fill_value`` for every month missing between each group's
    first and last month. ``df`` holds one row per (group, month), months as
    month-start dates (an aggregate, so its size is groups x months).

    One aggregation per group gathers its month -> values map with the first and
    last month (bounded by the months spanned, not by the data volume); the
    calendar is then exploded from those bounds and looked up in the map. The
    input is read once: no self-join of the aggregate. Rows without a month have
    no place in the calendar and are left out.
    """
    values = F.struct(*[F.col(c).alias(c) for c in value_cols])
    per_group = df.where(F.col(month_col).isNotNull()).groupBy(*group_cols).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(month_col), values))).alias("_gf_m"),
        F.min(month_col).alias("_gf_lo"), F.max(month_col).alias("_gf_hi"))
    calendar = per_group.select(
        *group_cols, "_gf_m",
        F.explode(F.sequence("_gf_lo", "_gf_hi", F.expr("INTERVAL 1 MONTH"))).alias(month_col))
    found = F.element_at(F.col("_gf_m"), F.col(month_col))
    return calendar.select(
        *group_cols, month_col,
        *[F.coalesce(found[c], F.lit(fill_value).cast(df.schema[c].dataType)).alias(c) for c in value_cols],
    )
