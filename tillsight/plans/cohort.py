"""Cohorts: signup-month activity (SQL notion) and first-purchase retention (pandas notion)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.dates import month_key, month_start, months_between_calendar
from tillsight.functions.numeric import round_float_half_even
from tillsight.plans.order_level import completed_orders
from tillsight.sources.model import RetailTables


def signup_cohort_activity(t: RetailTables) -> DataFrame:
    """Active customers per (signup month, activity month), activity on or after
    the signup month. Activity is completed orders, with or without lines.
    (customer, month) pairs are made distinct first, so a COUNT(*) per cell is
    the distinct-customer count."""
    # months are compared and grouped as first-of-month dates (same order as
    # the YYYY-MM text) and formatted only on the small result
    cohort = t.customers.select("customer_id", month_start(F.col("signup_date")).alias("_cohort"))
    activity = completed_orders(t.orders).select(
        "customer_id", month_start(F.col("order_date")).alias("_activity")).distinct()
    return (
        cohort.join(activity, "customer_id")
        .where(F.col("_activity") >= F.col("_cohort"))
        .groupBy("_cohort", "_activity")
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .select(month_key(F.col("_cohort")).alias("cohort_month"),
                month_key(F.col("_activity")).alias("activity_month"), "active_customers")
        .orderBy("cohort_month", "activity_month")
    )


def customer_months(t: RetailTables) -> DataFrame:
    """Distinct (customer, order month, first-purchase month).

    Deduplicating (customer, month) first (partial aggregation map-side) caps a
    customer at one row per month, so the per-customer window that finds the
    first month never sees an unbounded group."""
    cm = t.order_level.select(
        "customer_id", month_start(F.col("order_date")).alias("order_month")).distinct()
    return cm.withColumn("cohort_month", F.min("order_month").over(Window.partitionBy("customer_id")))


def purchase_cohort_counts(t: RetailTables) -> DataFrame:
    cm = customer_months(t)
    return (
        cm.withColumn("period", months_between_calendar(F.col("order_month"), F.col("cohort_month")))
        .groupBy("cohort_month", "period")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def purchase_cohort_retention(t: RetailTables, fill_observable_gaps: bool = False) -> DataFrame:
    """Share of each first-purchase cohort active n months later, rounded to 3
    decimals. Cells without activity are absent (NULL in the matrix) unless
    ``fill_observable_gaps`` adds zeros up to the data's last month."""
    counts = purchase_cohort_counts(t)
    if fill_observable_gaps:
        last = counts.select(F.max(F.add_months("cohort_month", F.col("period")))).scalar()
        cohorts = counts.select("cohort_month").distinct()
        grid = cohorts.select(
            "cohort_month",
            F.explode(F.sequence(F.lit(0), months_between_calendar(last, F.col("cohort_month")))).alias("period"))
        counts = grid.join(counts, ["cohort_month", "period"], "left").fillna(0, ["customers"])
    # the counts table is cohorts x periods: the per-cohort window is small
    size = F.max(F.when(F.col("period") == 0, F.col("customers"))).over(Window.partitionBy("cohort_month"))
    return (
        counts.withColumn("cohort_size", size)
        .withColumn("retention", round_float_half_even(F.col("customers") / F.col("cohort_size"), 3))
        .select("cohort_month", "period", "customers", "cohort_size", "retention")
        .orderBy("cohort_month", "period")
    )


def purchase_cohort_matrix(t: RetailTables, periods: int | None = None) -> DataFrame:
    """Cohort x period retention, columns m0, m1, ... in order, NULL for no activity.

    ``periods`` fixes the columns to the first so many; ``later_periods`` then counts a cohort's active
    periods after them, so none is lost unseen. Without it every period that occurs is a column; the names come from
    the data, so a small job finds them when the query is built."""
    ret = purchase_cohort_retention(t)
    listed = range(periods) if periods is not None else [
        r.period for r in ret.select("period").distinct().orderBy("period").collect()]  # months spanned
    wide = ret.groupBy("cohort_month").agg(
        *[F.max(F.when(F.col("period") == p, F.col("retention"))).alias(f"m{p}") for p in listed],
        F.count_if(F.col("period") >= len(listed)).alias("later_periods"))
    return (wide if periods is not None else wide.drop("later_periods")).orderBy("cohort_month")


def cohort_heatmap(t: RetailTables, periods: int = 12) -> DataFrame:
    """The first ``periods`` columns of the matrix in %, rounded to 1 digit: what the heatmap shows."""
    wide = purchase_cohort_matrix(t, periods)
    return wide.select("cohort_month", *[round_float_half_even(F.col(f"m{p}") * 100.0, 1).alias(f"m{p}_pct") for p in range(periods)])


def retention_curve_head(t: RetailTables, n: int = 6) -> DataFrame:
    """The first ``n`` periods of the mean curve, rounded to 1 digit."""
    curve = avg_retention_curve(t).where(F.col("period") < n)
    return curve.select("period", F.bround("avg_retention_pct", 1).alias("avg_retention_pct"))


def avg_retention_curve(t: RetailTables) -> DataFrame:
    """Unweighted mean retention per period over the cohorts that have the cell, in %,
    rounded half to even at 2 decimals. The mean is taken over exact 3-decimal
    values (decimal arithmetic), so a tie is a real tie and not summation noise."""
    ret = purchase_cohort_retention(t)
    exact_mean = F.avg(F.col("retention").cast("decimal(12,3)"))
    return (
        ret.groupBy("period")
        .agg(F.count(F.lit(1)).alias("cohorts"),
             F.bround(exact_mean * F.lit(Decimal(100)), 2).alias("avg_retention_pct"))
        .orderBy("period")
    )


def retention_m1_m3(t: RetailTables) -> DataFrame:
    curve = avg_retention_curve(t)
    return curve.agg(
        F.max(F.when(F.col("period") == 1, F.col("avg_retention_pct"))).alias("m1_retention_pct"),
        F.max(F.when(F.col("period") == 3, F.col("avg_retention_pct"))).alias("m3_retention_pct"),
    )
