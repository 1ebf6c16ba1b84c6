"""Sketches stored per cell, merged into any roll-up.

A cell is a month x region x channel (orders) or a region x channel (customers). Each
keeps sums and a sketch of fixed size; roll-ups merge the cells and never go back to the orders:
  * theta sketches of the customers (distinct counts; unions and intersections). Up to 2 ** ``LG_ENTRIES`` distinct
    customers the count is exact, beyond that its relative standard error is
    about 1 / sqrt(2 ** ``LG_ENTRIES``), 0.8 %;
  * KLL sketches of the customers' revenue (quantiles). Up to about ``KLL_K`` values they are exact, beyond
    that the normalised rank error is about 2.3 / ``KLL_K`` ** 0.94 at 99 %, 0.1 %.
The exact forms (``count_distinct``, ``rfm_scores``) stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.dates import month_start
from tillsight.operators.quantiles import QUARTILES, bin_score
from tillsight.plans.rfm import shared_customer_totals
from tillsight.shared import written
from tillsight.sources.model import RetailTables

LG_ENTRIES, KLL_K = 14, 4096


def order_cells(t: RetailTables, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """month, region, channel: orders, revenue, sketch of the customers (written once per model)."""
    key = f"order_cells:{lg_entries}"
    if key not in t.memo:
        t.memo[key] = written(t.order_level.groupBy(month_start(F.col("order_date")).alias("month"), "region", "acquisition_channel").agg(
            F.count(F.lit(1)).alias("orders"), F.sum("order_revenue").alias("revenue"),
            F.expr(f"theta_sketch_agg(customer_id, {lg_entries})").alias("customers")), "order-cells")
    return t.memo[key]


def customers_by_quarter_region(t: RetailTables, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Per quarter and region: orders, revenue, customers, and those of them who bought in the quarter before too.

    Everything comes from the stored cells: unions over months and channels, an intersection with the quarter before."""
    at = F.year("month") * 4 + F.quarter("month")
    rolled = order_cells(t, lg_entries).groupBy(at.alias("at"), "region").agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"), F.expr(f"theta_union_agg(customers, {lg_entries})").alias("sketch"))
    w = Window.partitionBy("region").orderBy("at")  # quarters of a region
    before = F.when(F.lag("at").over(w) == F.col("at") - 1, F.lag("sketch").over(w))
    rolled = rolled.withColumn("before", before)
    both = F.when(F.col("before").isNotNull(), F.expr("theta_sketch_estimate(theta_intersection(sketch, before))")).otherwise(0)
    quarter = F.concat(F.floor((F.col("at") - 1) / 4).cast("string"), F.lit("-Q"), ((F.col("at") - 1) % 4 + 1).cast("string"))
    return rolled.select(quarter.alias("order_quarter"), "region", "orders", "revenue", F.expr("theta_sketch_estimate(sketch)").alias("customers"),
                         both.cast("long").alias("returning_customers"))


def value_cells(t: RetailTables, k: int = KLL_K) -> DataFrame:
    """region, channel: customers and a sketch of their revenue (written once per model)."""
    key = f"value_cells:{k}"
    if key not in t.memo:
        buyers = shared_customer_totals(t).join(t.customers.select("customer_id", "region", "acquisition_channel"), "customer_id")
        t.memo[key] = written(buyers.groupBy("region", "acquisition_channel").agg(
            F.count(F.lit(1)).alias("customers"), F.expr(f"kll_sketch_agg_double(cast(monetary AS double), {k})").alias("values")), "value-cells")
    return t.memo[key]


def value_quartiles_by_region(t: RetailTables, k: int = KLL_K) -> DataFrame:
    """Per region: customers and the quartiles of their revenue (the smallest value with at least that share at or below)."""
    merged = value_cells(t, k).groupBy("region").agg(F.sum("customers").alias("customers"), F.expr(f"kll_merge_agg_double(values, {k})").alias("sketch"))
    edges = merged.withColumn("q", F.expr(f"kll_sketch_get_quantile_double(sketch, array({', '.join(f'{p}D' for p in QUARTILES)}))"))
    return edges.select("region", "customers", *[F.col("q")[i].alias(f"q{int(p * 100)}") for i, p in enumerate(QUARTILES)])


def value_scores_by_region(t: RetailTables, k: int = KLL_K) -> DataFrame:
    """Each buying customer's quartile score within the region, from the merged sketches: no sort of the customers."""
    edges = value_quartiles_by_region(t, k).select(F.col("region").alias("_of"), F.array("q25", "q50", "q75").alias("_edges"))
    buyers = shared_customer_totals(t).join(t.customers.select("customer_id", "region"), "customer_id")
    return buyers.join(edges, F.col("region").eqNullSafe(F.col("_of"))).select(
        "customer_id", "region", "monetary", bin_score(F.col("monetary"), F.col("_edges")).alias("value_score"))
