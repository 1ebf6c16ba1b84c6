"""Data quality report over the retail model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.quality import Reference, count_where, foreign_key_orphans, primary_key_violations, table_profile
from tillsight.sources.model import RetailTables


def dq_table_profile(t: RetailTables) -> DataFrame:
    """rows, null cells and duplicate rows for orders, order_items, products, customers."""
    parts = [table_profile(t.orders, "orders"), table_profile(t.order_items, "order_items"),
             table_profile(t.products, "products"), table_profile(t.customers, "customers")]
    return reduce(DataFrame.unionByName, parts)


def dq_invalid_values(t: RetailTables) -> DataFrame:
    """Order lines with a non-positive price or quantity."""
    return count_where(t.order_items, {
        "invalid_prices": F.col("unit_price") <= 0,
        "invalid_quantities": F.col("quantity") <= 0,
    })


def dq_primary_keys(t: RetailTables) -> DataFrame:
    parts = [primary_key_violations(t.customers, "customers", ["customer_id"]),
             primary_key_violations(t.products, "products", ["product_id"]),
             primary_key_violations(t.orders, "orders", ["order_id"])]
    return reduce(DataFrame.unionByName, parts)


REFERENCES = [Reference("orders", "customer_id", "customers", "customer_id"), Reference("order_items", "order_id", "orders", "order_id"),
              Reference("order_items", "product_id", "products", "product_id"), Reference("ab_test_campaign", "customer_id", "customers", "customer_id")]


def dq_foreign_keys(t: RetailTables) -> DataFrame:
    """Orphans of the four references; customers, orders, lines and products are read once each."""
    return foreign_key_orphans(t.as_dict(), REFERENCES)
