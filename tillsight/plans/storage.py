"""Queries on how the tables are stored: clustered files, inferred types, published versions."""

from __future__ import annotations

import calendar
import datetime as dt
import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.dates import month_start
from tillsight.shared import scratch_folder
from tillsight.sources.infer import column_types
from tillsight.sources.layout import read_where, write_clustered
from tillsight.sources.model import RetailTables
from tillsight.sources.publish import Refused, publish, read_published, versions

#: Files of the clustered order level, and order ids that a file's Bloom filter is made for.
FILES, IDS_PER_FILE = 64, 1 << 16


def clustered_order_level(t: RetailTables, files: int = FILES) -> str:
    """Folder of the order level clustered by customer and date (written once per model)."""
    if "clustered" not in t.memo:
        path = os.path.join(scratch_folder(t.order_level.sparkSession, "clustered"), "order_level")
        write_clustered(t.order_level, path, ["customer_id", "order_date"], files, {"order_id": IDS_PER_FILE})
        t.memo["clustered"] = path
    return t.memo["clustered"]


def orders_of_customer_month(t: RetailTables, customer, month: dt.date) -> DataFrame:
    """A customer's orders of a month; opens only files whose ranges meet both."""
    last = month.replace(day=calendar.monthrange(month.year, month.month)[1])
    return read_where(t.order_level.sparkSession, clustered_order_level(t), {"customer_id": (customer, customer), "order_date": (month, last)})


def best_customer_month(t: RetailTables) -> DataFrame:
    """The orders of the customer and month with the highest revenue (ties: smaller customer id, earlier month)."""
    cells = t.order_level.where("customer_id IS NOT NULL AND order_date IS NOT NULL").groupBy("customer_id", month_start(F.col("order_date")).alias("month")).agg(F.sum("order_revenue").alias("v"))
    top = cells.orderBy(F.desc("v"), "customer_id", "month").limit(1).collect()
    return orders_of_customer_month(t, top[0].customer_id, top[0].month) if top else t.order_level


def csv_types(t: RetailTables) -> DataFrame:
    """Inferred type and counts of every column of the five tables, as their CSV exports spell them."""
    def of(name: str, df: DataFrame) -> DataFrame:
        return column_types(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])).select(F.lit(name).alias("table_name"), "*")
    return reduce(DataFrame.unionAll, [of(n, df) for n, df in t.as_dict().items()])


def published_tables(t: RetailTables) -> DataFrame:
    """Customers, products and orders published with their keys: version, rows, and whether a version with repeated keys was refused."""
    spark, out = t.customers.sparkSession, []
    folder = scratch_folder(spark, "published")
    for name, key in (("customers", "customer_id"), ("products", "product_id"), ("orders", "order_id")):
        df, target = t.as_dict()[name], os.path.join(folder, name)
        publish(df, target, [key], least_rows=0)
        again = read_published(spark, target)
        try:
            publish(again.unionAll(again), target, [key], least_rows=0)
            refused = False
        except Refused:
            refused = True
        out.append(read_published(spark, target).agg(
            F.lit(name).alias("table_name"), F.lit(versions(spark, target)[-1]).alias("version"), F.count(F.lit(1)).alias("rows"),
            F.count_distinct(key).alias("distinct_keys"), F.lit(refused).alias("refused")))
    return reduce(DataFrame.unionAll, out)
