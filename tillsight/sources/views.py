"""Expose the retail model to Spark SQL as temporary views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillsight.sources.model import RetailTables


def register_views(spark: SparkSession, t: RetailTables, prefix: str = "") -> list[str]:
    """Create temp views customers, products, orders, order_items,
    ab_test_campaign and order_level (optionally prefixed) over the model.
    Views are lazy: a SQL query over them is planned by Catalyst like any
    DataFrame query, with the same pushdown and pruning."""
    names = []
    for name, df in {**t.as_dict(), "order_level": t.order_level}.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
