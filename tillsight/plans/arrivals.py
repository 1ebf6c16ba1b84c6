"""The order level kept current while orders and lines arrive in files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.shared import hadoop_path, scratch_folder, small, written
from tillsight.sources.adapter import read_driver_table
from tillsight.sources.refresh import read_refreshed, refresh, warehouse_facts

# Fixed values of the two deliveries, the same in the oracle: every 97th order of 2001 comes late, every 89th of 2000 is
# first delivered with a date 40 days earlier, the lines of every 83rd order of 1999 come late.
LATE, MOVED, LATE_LINES, EARLIER = (97, 2001), (89, 2000), (83, 1999), 40


def order_level_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month: orders, revenue, and whether the second delivery rewrote it.

    All orders and lines are delivered in two lots of files, each followed by a refresh. The second lot brings late orders
    and late lines and replaces a file by one with corrected dates."""
    folder = scratch_folder(spark, "arrivals")
    orders, lines = read_driver_table(spark, sf_dir, "orders"), read_driver_table(spark, sf_dir, "lineitem")

    def every(rule):
        n, year = rule
        return F.coalesce((F.col("o_orderkey") % n == 0) & (F.year("o_orderdate") == year), F.lit(False))

    def deliver(rows: DataFrame, table: str, name: str) -> str:
        rows.write.parquet(path := os.path.join(folder, f"{table}.parquet", name))
        return path

    # written and counted first: the joins with it are planned before its size is known, and would shuffle and sort whole lines
    tardy = small(written(orders.where(every(LATE_LINES)).select(F.col("o_orderkey").alias("l_orderkey")).distinct(), "late-lines"))
    facts, target = warehouse_facts(spark, sf_dir, folder), os.path.join(folder, "out")
    deliver(orders.where(~every(LATE) & ~every(MOVED)), "orders", "first")
    wrong = deliver(orders.where(every(MOVED)).withColumn("o_orderdate", F.col("o_orderdate") - F.expr(f"INTERVAL {EARLIER} DAYS")), "orders", "open")
    deliver(lines.join(tardy, "l_orderkey", "left_anti").select(lines.columns), "lineitem", "first")
    refresh(spark, facts, target)

    fs, at = hadoop_path(spark, wrong)
    fs.delete(at, True)
    deliver(orders.where(every(MOVED)), "orders", "closed")
    deliver(orders.where(every(LATE)), "orders", "late")
    deliver(lines.join(tardy, "l_orderkey", "left_semi").select(lines.columns), "lineitem", "late")
    months = refresh(spark, facts, target).months
    return read_refreshed(spark, target).groupBy("order_month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_revenue").alias("revenue"),
        F.lit(True).alias("rewritten") if months is None else F.col("order_month").isin(months).alias("rewritten"))
