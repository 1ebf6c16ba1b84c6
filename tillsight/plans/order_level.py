"""The order-level table: one row per completed order that has lines.

Shape of the plan (what Catalyst is given, and why):
  * line revenue is summed per order_id first. The partial aggregate runs
    map-side, before any shuffle of the lines, so when the lines' product join
    is a broadcast (a catalogue is small) the lines cross the network as about
    one row per order instead of one row per line;
  * the per-order sums come out hash-partitioned by order_id, so the inner
    join with the completed orders shuffles only the orders side. The inner
    join also drops the sums of non-completed orders and drops completed orders
    without lines, as in the source analysis.
Revenue is quantity x the line's unit price, summed as an exact decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.sources.model import COMPLETED

ORDER_LEVEL_COLUMNS = ["order_id", "customer_id", "order_date", "region", "acquisition_channel", "order_revenue"]


def completed_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == F.lit(COMPLETED))


def completed_lines(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Order lines that belong to completed orders (left semi join on the order
    ids; the line-level aggregations that follow group by other keys)."""
    return order_items.join(completed_orders(orders).select("order_id"), "order_id", "left_semi")


def line_revenue(order_items: DataFrame):
    return F.col("quantity") * F.col("unit_price")


def with_revenue(completed: DataFrame, revenue: DataFrame, kind=None) -> DataFrame:
    """Completed orders joined with their revenue, one row per order id, customer, date, region and channel: rows of a
    repeated order add up, as in the source analysis. The rows are already partitioned by order id, so this costs no shuffle."""
    kind = kind or revenue.schema["order_revenue"].dataType
    return (completed.join(revenue, "order_id").groupBy(*ORDER_LEVEL_COLUMNS[:-1])
            .agg(F.sum("order_revenue").cast(kind).alias("order_revenue")))


def build_order_level(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    revenue = order_items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("order_revenue"))
    return with_revenue(completed_orders(orders), revenue)


def order_level(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """The order-level table built from the two relations."""
    return build_order_level(orders, order_items)
