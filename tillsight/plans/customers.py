"""Customer views: RFM inputs, top customers per region, churn candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.dates import year_range
from tillsight.functions.numeric import round_sql
from tillsight.functions.text import padded_id
from tillsight.operators.ranking import ordinal_rank, top_k_per_group
from tillsight.plans.order_level import completed_orders
from tillsight.sources.model import RetailTables


def rfm_inputs(t: RetailTables) -> DataFrame:
    """Per customer: days from their last order to the data's last order date
    (0 for the latest buyers), number of completed orders, revenue.

    Starts from the per-customer totals shared with the RFM scores (written
    once); the data's last date is the MAX over those rows, a scalar subquery."""
    from tillsight.plans.rfm import shared_customer_totals, with_recency

    totals = with_recency(shared_customer_totals(t), offset_days=0)
    return totals.select(
        "customer_id", F.col("recency").alias("recency_days"), "frequency",
        round_sql(F.col("monetary"), 2).alias("monetary"),
    ).orderBy(F.desc("monetary"))


def customer_lifetime_value(t: RetailTables) -> DataFrame:
    """(customer_id, region, lifetime_value): revenue of completed orders, with the
    customer's own region. Revenue is reduced to one row per customer before the
    join with customers."""
    per_customer = (
        t.order_level
        .groupBy("customer_id")
        .agg(F.sum("order_revenue").alias("lifetime_value"))
    )
    return t.customers.select("customer_id", "region").join(per_customer, "customer_id")


def top_customers_by_region(t: RetailTables, k: int = 5) -> DataFrame:
    """Customers ranked by lifetime value inside their region; RANK keeps ties,
    so a region may return more than k rows."""
    ranked = top_k_per_group(customer_lifetime_value(t), ["region"], [F.desc("lifetime_value")], k,
                             rank_col="region_rank")
    return ranked.select("customer_id", "region", "lifetime_value", "region_rank").orderBy("region", "region_rank")


def churn_candidates(t: RetailTables, active_year: int = 2024, lapsed_year: int = 2025) -> DataFrame:
    """Customers with a completed order in ``active_year`` and none in ``lapsed_year``.

    One scan of the orders: both tests are a conditional maximum per customer, so a heavy customer's orders fold map-side
    and the right side of the semi join has one row per customer. The years are date ranges, which
    reach the Parquet scan."""
    in_active, in_lapsed = (year_range(F.col("order_date"), y) for y in (active_year, lapsed_year))
    lapsed = (completed_orders(t.orders).where(in_active | in_lapsed).groupBy("customer_id")
              .agg(F.bool_or(in_active).alias("active"), F.bool_or(in_lapsed).alias("again")).where("active AND NOT again"))
    return t.customers.join(lapsed.select("customer_id"), "customer_id", "left_semi").select("customer_id", "region", "acquisition_channel").distinct()


def customers_by_signup(t: RetailTables) -> DataFrame:
    """Customers in signup order with a fresh 0-based row index (ties by id),
    numbered by the distributed ordinal rank rather than a one-task window."""
    ranked = ordinal_rank(t.customers.select("customer_id", "signup_date", "region", "acquisition_channel"),
                          [F.col("signup_date"), F.col("customer_id")], "row_index")
    return ranked.select((F.col("row_index") - 1).alias("row_index"), "customer_id", "signup_date",
                         "region", "acquisition_channel")


def customer_codes(t: RetailTables) -> DataFrame:
    """Zero-padded text ids (``CUST00042``) for integer customer keys; text keys
    are already codes and pass through."""
    cid = F.col("customer_id")
    if isinstance(t.customers.schema["customer_id"].dataType, (T.LongType, T.IntegerType)):
        code = padded_id("CUST", cid, 5)
    else:
        code = cid.cast("string")
    return t.customers.select("customer_id", code.alias("customer_code"))
