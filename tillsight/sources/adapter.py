"""Map the warehouse tables (region, nation, customer, part, orders, lineitem)
onto the retail model.

Mapping (fixed values, the same in the DuckDB oracle):
  customer      -> customers: region from nation/region (NULL if unknown), channel = c_mktsegment,
                   signup date = 1995-01-01 + (custkey * 37) % 2000 days
  part          -> products: category = p_type, price = p_retailprice,
                   cost = price * (40 + partkey % 26) %
  orders        -> orders: status F completed, O returned, else cancelled;
                   region and channel copied from the customer (NULL when the
                   customer is unknown)
  lineitem      -> order_items: quantity, unit price = extended price / quantity,
                   unit cost = price * (40 + partkey % 26) %, in whole cents
  customers     -> campaign: all customers, arms by hash,
                   converted when the customer has completed revenue in
                   2000-01 .. 2000-02, order_value = that revenue
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.numeric import money
from tillsight.operators.sampling import assign_arm
from tillsight.shared import written
from tillsight.sources.model import COMPLETED, RetailTables

# Fixed values of the mapping.
SIGNUP_BASE_DATE = "1995-01-01"
SIGNUP_SPREAD_DAYS = 2000
SIGNUP_MULTIPLIER = 37
COST_PCT_BASE = 40
COST_PCT_SPREAD = 26
STATUS_MAP = {"F": "completed", "O": "returned"}
OTHER_STATUS = "cancelled"
CAMPAIGN_START = "2000-01-01"
CAMPAIGN_END = "2000-03-01"
ARM_SALT = "arm"


# Declared schemas of the warehouse tables (no footer inference at read time;
# Catalyst still prunes to the columns a plan uses).
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str, files: Sequence[str] | None = None) -> DataFrame:
    """A warehouse table, or only some of its ``files``."""
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    if files is None:
        return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return reader.parquet(*files) if files else spark.createDataFrame([], DRIVER_SCHEMAS[name])


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with region (via nation) and channel.

    Nation and region are attached by LEFT joins with one row per key, so
    Catalyst removes both joins from every plan that does not read the region
    (ids, signup dates and channels need neither). Where the region is read,
    the planner broadcasts these small dimensions from their measured size.
    """
    c = read_driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_driver_table(spark, sf_dir, "nation").groupBy("n_nationkey").agg(
        F.min("n_regionkey").alias("n_regionkey"))
    r = read_driver_table(spark, sf_dir, "region").groupBy("r_regionkey").agg(F.min("r_name").alias("r_name"))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(r, n.n_regionkey == r.r_regionkey, "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.date_add(
                F.lit(SIGNUP_BASE_DATE).cast("date"),
                ((F.col("c_custkey") * SIGNUP_MULTIPLIER) % SIGNUP_SPREAD_DAYS).cast("int"),
            ).alias("signup_date"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("acquisition_channel"),
        )
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    price = money(F.col("p_retailprice"))
    pct = (F.lit(COST_PCT_BASE) + F.col("p_partkey") % COST_PCT_SPREAD).cast("decimal(4,0)")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        price.alias("unit_price"),
        money(F.round(price * pct * F.lit(0.01).cast("decimal(3,2)"), 2)).alias("unit_cost"),
        F.col("p_name").alias("product_name"),
    )


def _status(code):
    """Null-safe tests, so a filter on the status becomes one on the code and reaches the Parquet reader."""
    expr = F.lit(OTHER_STATUS)
    for k, v in reversed(list(STATUS_MAP.items())):
        expr = F.when(code.eqNullSafe(k), F.lit(v)).otherwise(expr)
    return expr


def orders_of(raw: DataFrame, customers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Orders of the warehouse rows ``raw`` (with its columns ``keep``) with the customer's region and channel copied on.

    The attributes come from a LEFT join with one row per customer (grouped by
    the key), so Catalyst drops the join entirely from every plan that does not
    read region or channel (most of them only need ids, dates and status).
    """
    o = raw.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", *keep)
    attrs = customers.groupBy("customer_id").agg(
        F.min("region").alias("region"), F.min("acquisition_channel").alias("acquisition_channel"))
    return o.join(attrs, o.o_custkey == attrs.customer_id, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        _status(F.col("o_orderstatus")).alias("status"),
        "region",
        "acquisition_channel",
        *keep,
    )


def order_items_of(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Order lines of the warehouse rows ``raw`` (with its columns ``keep``) with the price the line itself carries, so no join with part.

    Quantities keep three decimals. Unit price is extended price / quantity and unit cost a share of it, both in
    whole cents (half up), which every engine computes alike. Lines of unknown parts stay.
    """
    li = raw.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", *keep)
    li = (li.withColumn("q", F.expr("cast(round(l_quantity * 1000) AS bigint)"))
          .withColumn("cents", F.expr("(2000 * cast(round(l_extendedprice * 100) AS bigint) + q) div nullif(2 * q, 0)"))
          .withColumn("cost", F.expr(f"(2 * cents * ({COST_PCT_BASE} + l_partkey % {COST_PCT_SPREAD}) + 100) div 200")))
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.expr("cast(cast(q AS decimal(12,0)) * 0.001BD AS decimal(12,3))").alias("quantity"),
        F.expr("cast(cast(cents AS decimal(12,0)) * 0.01BD AS decimal(12,2))").alias("unit_price"),
        F.expr("cast(cast(cost AS decimal(12,0)) * 0.01BD AS decimal(12,2))").alias("unit_cost"),
        *keep,
    )


def _campaign(customers: DataFrame, order_level: DataFrame) -> DataFrame:
    window_revenue = (
        order_level
        .where((F.col("order_date") >= F.lit(CAMPAIGN_START).cast("date"))
               & (F.col("order_date") < F.lit(CAMPAIGN_END).cast("date")))
        .groupBy("customer_id")
        .agg(F.sum("order_revenue").alias("_v"))
    )
    return (
        customers.select("customer_id").join(window_revenue, "customer_id", "left")
        .select(
            "customer_id",
            assign_arm(F.col("customer_id"), ARM_SALT).alias("grp"),
            F.when(F.col("_v").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("converted"),
            F.coalesce(F.col("_v"), F.lit(0).cast("decimal(12,2)")).alias("order_value"),
        )
    )


def retail_from_driver(spark: SparkSession, sf_dir: str, share_order_level: bool | str = False) -> RetailTables:
    """Build the retail model lazily over the parquet tables in ``sf_dir``.

    ``share_order_level`` materialises the order-level table once for every
    later query on this model:
      * ``"parquet"`` (or True): Parquet files in the session's
        ``spark.checkpoint.dir``. The lineage is cut, so a lost executor costs a
        re-read of those files, not a recomputation of the order and line joins,
        and later queries read only their columns.
      * ``"persist"``: executor memory, then disk; lost blocks are recomputed.
    """
    t: RetailTables

    def customers():
        return _customers(spark, sf_dir)

    def products():
        return _products(spark, sf_dir)

    def orders():
        return orders_of(read_driver_table(spark, sf_dir, "orders"), t.customers)

    def order_items():
        return order_items_of(read_driver_table(spark, sf_dir, "lineitem"))

    def campaign():
        return _campaign(t.customers, t.order_level)

    def order_level():
        from tillsight.plans.order_level import build_order_level
        ol = build_order_level(t.orders, t.order_items)
        if share_order_level == "persist":
            return ol.persist(StorageLevel.MEMORY_AND_DISK)
        if share_order_level:
            return written(ol, "order-level")
        return ol

    t = RetailTables(customers, products, orders, order_items, campaign, order_level)
    return t


__all__ = ["retail_from_driver", "read_driver_table", "COMPLETED"]
