"""File sources and sinks for the retail model.

Readers take explicit schemas (no inference). Writers never funnel data into
one task: CSV/JSON outputs are directories of part files, tables are written
partitioned (by order month) or bucketed (by key) for later pruning and
shuffle-free joins.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillsight.functions.dates import month_start
from tillsight.sources.model import SCHEMAS, RetailTables

CSV_FILES = {
    "customers": "customers.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "ab_test_campaign": "ab_test_campaign.csv",
}


def read_csv_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One model table from CSV, its columns found by header name and typed by the model's schema.

    Columns may come in any order and others may stand between them; a missing one is an
    error, and so is a file of the folder whose header differs from that of the first.
    The campaign export names its arm column ``group``; it is read as ``grp``."""
    wanted = SCHEMAS[name]
    alias = {"group": "grp"} if "grp" in wanted.names else {}
    header = spark.read.option("header", True).csv(path).columns
    found = {alias.get(c, c): c for c in header}
    missing = [c for c in wanted.names if c not in found]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; the header has {', '.join(header)}")
    types = {found[f.name]: f.dataType for f in wanted}
    schema = StructType([StructField(c, types.get(c, StringType())) for c in header])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(*[F.col(f"`{found[c]}`").alias(c) for c in wanted.names])


def read_retail_csv(spark: SparkSession, data_dir: str) -> RetailTables:
    """The five model tables from a folder of CSV exports."""
    def loader(name):
        return lambda: read_csv_table(spark, os.path.join(data_dir, CSV_FILES[name]), name)
    return RetailTables(loader("customers"), loader("products"), loader("orders"),
                        loader("order_items"), loader("ab_test_campaign"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; key columns are ordinary columns (no index)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_order_level(order_level: DataFrame, path: str) -> None:
    """The shared order-level table, partitioned by order month so month and
    year filters prune whole folders."""
    write_parquet(order_level.withColumn("order_month", month_start(F.col("order_date"))), path,
                  partition_by=["order_month"])


def read_order_level(spark: SparkSession, path: str) -> DataFrame:
    """An order-level table written by ``write_order_level``; filters on
    order_date can be mirrored on order_month to prune folders."""
    return spark.read.parquet(path).drop("order_month")


def save_table(df: DataFrame, name: str, bucket_by: list[str] | None = None, buckets: int = 64,
               sort_by: list[str] | None = None, partition_by: list[str] | None = None,
               mode: str = "overwrite") -> None:
    """Drop-and-create a catalog table. Bucketing by a join key lets later joins
    and aggregations on that key skip the shuffle (the secondary-index idea of
    the row store, as a data layout)."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(buckets, *bucket_by)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(name)
