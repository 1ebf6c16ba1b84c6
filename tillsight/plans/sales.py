"""Revenue views: monthly trend, categories, KPIs, region x channel, insights."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.dates import month_key, month_label, month_label_short, month_start
from tillsight.functions.numeric import mean_sql, round_sql, safe_div
from tillsight.functions.text import product_code
from tillsight.operators.gapfill import fill_month_gaps
from tillsight.operators.shares import share_of_max_bounded
from tillsight.plans.order_level import completed_orders
from tillsight.sources.model import COMPLETED, RetailTables

HOLIDAY_MONTHS = (11, 12)  # fixed value: Nov/Dec


def hundred():
    """100.0 as an exact decimal literal (keeps percent arithmetic in decimals)."""
    return F.lit(Decimal("100.0"))


def monthly_revenue_growth(t: RetailTables) -> DataFrame:
    """Months with completed revenue, the change from the previous listed month
    (LAG steps over missing months) and the % change (NULL after a zero month).

    The window has no partition key on purpose: it runs over the monthly
    aggregate, whose size is the number of calendar months, not the data size.
    """
    # group on the month's first day (a cheap date op per row); the text key is
    # formatted only on the monthly result, and sorts the same way
    monthly = (
        t.order_level
        .groupBy(month_start(F.col("order_date")).alias("_month"))
        .agg(F.sum("order_revenue").alias("revenue"))
    )
    prev = F.lag("revenue").over(Window.orderBy("_month"))
    return monthly.select(
        month_key(F.col("_month")).alias("order_month"),
        "revenue",
        round_sql(F.col("revenue") - prev, 2).alias("revenue_change"),
        round_sql(safe_div(hundred() * (F.col("revenue") - prev), prev), 1).alias("pct_change"),
    ).orderBy("order_month")


def completed_lines_sold(t: RetailTables) -> DataFrame:
    """Lines of completed orders. The orders come first, so lines of other orders are gone before any
    work by product (an inner join on order_id, as in the source query)."""
    return t.order_items.join(completed_orders(t.orders).select("order_id"), "order_id")


def category_margin(t: RetailTables) -> DataFrame:
    """Orders, units, revenue, gross profit and margin % per category (line prices and costs).

    Sums are taken per product first, map-side, so a product that holds a third of all lines is one row when it meets
    its category. Only the count of distinct orders needs (order, category) pairs; they come from
    distinct (order, product) pairs, two ids wide, whose join a hot product cannot pin to one task (AQE
    splits it, or the categories are broadcast)."""
    lines = completed_lines_sold(t)
    revenue, cost = F.col("quantity") * F.col("unit_price"), F.col("quantity") * F.col("unit_cost")
    category = t.products.select("product_id", "category")
    sums = (lines.groupBy("product_id").agg(F.sum("quantity").alias("units"), F.sum(revenue).alias("revenue"), F.sum(cost).alias("cost"))
            .join(category, "product_id").groupBy("category").agg(*[F.sum(c).alias(c) for c in ("units", "revenue", "cost")]))
    baskets = (lines.select("order_id", "product_id").distinct().join(category, "product_id")
               .groupBy("category").agg(F.count_distinct("order_id").alias("orders_containing_category")))
    profit = F.col("revenue") - F.col("cost")
    return (
        sums.withColumnRenamed("category", "_category").join(baskets, F.col("_category").eqNullSafe(F.col("category")))
        .select(
            "category", "orders_containing_category",
            F.col("units").alias("units_sold"),
            round_sql(F.col("revenue"), 2).alias("revenue"),
            round_sql(profit, 2).alias("gross_profit"),
            round_sql(safe_div(hundred() * profit, F.col("revenue")), 1).alias("margin_pct"),
        )
        .orderBy(F.desc("revenue"))
    )


def category_revenue(t: RetailTables) -> DataFrame:
    """Line revenue per category, ascending (the bar-chart order): per product first, so no category or product is hot."""
    per_product = completed_lines_sold(t).groupBy("product_id").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue"))
    return (
        per_product.join(t.products.select("product_id", "category"), "product_id")
        .groupBy("category").agg(F.sum("revenue").alias("revenue"))
        .orderBy("revenue")
    )


def kpis(t: RetailTables) -> DataFrame:
    """One row: revenue, completed orders, customers, average order value, completion rate."""
    ol = t.order_level
    completion = t.orders.select(
        safe_div(F.count_if(F.col("status") == F.lit(COMPLETED)), F.count(F.lit(1))).alias("r")).scalar()
    return ol.agg(
        round_sql(F.sum("order_revenue"), 2).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        mean_sql(ol, "order_revenue", 2).alias("aov"),
    ).withColumn("completion_rate", F.round(completion, 4))


def eda_key_figures(t: RetailTables) -> DataFrame:
    """The figures the exploration step prints, as (metric, value) rows."""
    counts = t.orders.agg(F.count(F.lit(1)).alias("total_orders"),
                          F.count_if(F.col("status") == F.lit(COMPLETED)).alias("completed_orders"))
    # one scalar subquery (one read of the order-level table) for both figures,
    # bound once as a column so that it is evaluated once
    rev = t.order_level.select(F.struct(
        round_sql(F.sum("order_revenue"), 2).cast("double").alias("total"),
        mean_sql(t.order_level, "order_revenue", 2).cast("double").alias("aov"))).scalar()
    counts = counts.select("*", rev.alias("_rev"))
    total, aov = F.col("_rev.total"), F.col("_rev.aov")
    def row(name: str, value):
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
    rows = F.array(
        row("total_orders", F.col("total_orders")),
        row("completed_orders", F.col("completed_orders")),
        row("completion_rate", F.round(safe_div(F.col("completed_orders"), F.col("total_orders")), 4)),
        row("total_revenue", total),
        row("average_order_value", aov),
    )
    return counts.select(F.inline(rows))


def kpi_strip(t: RetailTables) -> DataFrame:
    """The dashboard's KPI tiles as display text: $M revenue, thousands separators."""
    k = kpis(t)
    millions = round_sql(F.col("total_revenue").cast("decimal(38,2)") / F.lit(Decimal(1000000)), 2)
    return k.select(
        F.concat(F.lit("$"), F.format_number(millions, 2), F.lit("M")).alias("total_revenue_text"),
        F.format_number(F.col("total_orders"), 0).alias("total_orders_text"),
        F.format_number(F.col("total_customers"), 0).alias("total_customers_text"),
        F.concat(F.lit("$"), F.format_number(F.col("aov"), 2)).alias("aov_text"),
    )


def monthly_revenue_filled(t: RetailTables) -> DataFrame:
    """Revenue per calendar month from first to last month, 0 for months without sales."""
    monthly = (
        t.order_level
        .groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(F.sum("order_revenue").alias("revenue"))
    )
    return fill_month_gaps(monthly, "month", ["revenue"]).orderBy("month")


def monthly_revenue_filled_by_cell(t: RetailTables) -> DataFrame:
    """The same series per (region, channel); here months without sales do occur."""
    keys = ["region", "acquisition_channel"]
    monthly = (
        t.order_level
        .groupBy(*keys, month_start(F.col("order_date")).alias("month"))
        .agg(F.sum("order_revenue").alias("revenue"))
    )
    return fill_month_gaps(monthly, "month", ["revenue"], group_cols=keys).orderBy(*keys, "month")


def region_channel_long(t: RetailTables) -> DataFrame:
    """Revenue per (order region, order channel), long form."""
    return (
        t.order_level
        .groupBy("region", "acquisition_channel")
        .agg(F.sum("order_revenue").alias("revenue"))
        .orderBy("region", "acquisition_channel")
    )


def region_channel_matrix(t: RetailTables, channels: list[str] | None = None) -> DataFrame:
    """Pivot: one row per region, one column per channel (NULL where no revenue).

    With the channel list given, the pivot needs no extra job to discover it,
    the schema is stable, and a last column ``other`` holds the revenue of unknown
    and missing channels, so a row always sums to its region. Without it Spark
    finds the (few) distinct channels first.
    """
    cells = t.order_level
    if channels:
        known = F.col("acquisition_channel").isin(*channels)
        cells = cells.withColumn("acquisition_channel", F.when(known, F.col("acquisition_channel")).otherwise("other"))
    return (
        cells
        .groupBy("region")
        .pivot("acquisition_channel", [*channels, "other"] if channels else None)
        .agg(F.sum("order_revenue"))
        .orderBy("region")
    )


def channel_rank_by_region(t: RetailTables) -> DataFrame:
    """Channels ranked by revenue inside each region (1 = strongest), with the
    weakest flagged. The window runs over the region x channel aggregate."""
    cells = region_channel_long(t)
    w_desc = Window.partitionBy("region").orderBy(F.desc("revenue"))
    w_asc = Window.partitionBy("region").orderBy(F.asc("revenue"))
    return cells.select(
        "region", "acquisition_channel", "revenue",
        F.rank().over(w_desc).alias("channel_rank"),
        (F.rank().over(w_asc) == 1).alias("is_weakest"),
    ).orderBy("region", "channel_rank")


def revenue_share_of_max(t: RetailTables) -> DataFrame:
    """Each region x channel cell as a fraction of the largest cell (heat-map scale)."""
    cells = region_channel_long(t)
    # regions x channels cells: a window over the aggregate reads it once
    return cells.select(
        "region", "acquisition_channel", "revenue",
        F.round(share_of_max_bounded("revenue"), 6).alias("share_of_max"),
    )


def trend_insight(t: RetailTables) -> DataFrame:
    """Peak month, growth from the first to the last month, and the Nov/Dec uplift
    (mean of Nov/Dec months over the mean of the others, minus 1, in %),
    over the gap-filled monthly series."""
    series = monthly_revenue_filled(t).withColumn("rev", F.col("revenue").cast("double"))
    is_holiday = F.month("month").isin(*HOLIDAY_MONTHS)
    agg = series.agg(
        F.max_by("month", F.struct(F.col("rev"), F.negative(F.unix_date("month")))).alias("peak_month"),
        F.max("rev").alias("peak_revenue"),
        F.min_by("rev", "month").alias("first_revenue"),
        F.max_by("rev", "month").alias("last_revenue"),
        F.avg(F.when(is_holiday, F.col("rev"))).alias("holiday_avg"),
        F.avg(F.when(~is_holiday, F.col("rev"))).alias("other_avg"),
    )
    return agg.select(
        month_label(F.col("peak_month")).alias("peak_month_label"),
        F.round(F.col("peak_revenue"), 2).alias("peak_revenue"),
        F.month("peak_month").isin(*HOLIDAY_MONTHS).alias("peak_in_holiday"),
        F.round(safe_div(F.col("last_revenue"), F.col("first_revenue")), 4).alias("growth_multiple"),
        F.round((safe_div(F.col("holiday_avg"), F.col("other_avg")) - F.lit(1.0)) * F.lit(100.0), 4)
        .alias("holiday_uplift_pct"),
    )


def month_labels(t: RetailTables) -> DataFrame:
    """Chart labels for every month with completed revenue."""
    months = t.order_level.select(month_start(F.col("order_date")).alias("month")).distinct()
    return months.select(
        month_key(F.col("month")).alias("order_month"),
        month_label(F.col("month")).alias("label"),
        month_label_short(F.col("month")).alias("short_label"),
    ).orderBy("order_month")


def product_codes(t: RetailTables) -> DataFrame:
    code = product_code(F.col("category"), F.col("product_id"))
    return t.products.select("product_id", "category", code.alias("product_code"))

