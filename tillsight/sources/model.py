"""The retail data model: five base relations with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Explicit schemas (no inference). Ids are whatever the source uses: text ids
# in CSV exports, integer keys when the model is derived from warehouse tables.
CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("region", T.StringType()),
    T.StructField("acquisition_channel", T.StringType()),
    T.StructField("loyalty_score", T.DoubleType()),
])
PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("unit_price", MONEY),
    T.StructField("unit_cost", MONEY),
    T.StructField("product_name", T.StringType()),
])
ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("acquisition_channel", T.StringType()),
])
ORDER_ITEMS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
    T.StructField("unit_cost", MONEY),
])
# The campaign export names the arm column ``group``; the model calls it ``grp``.
CAMPAIGN_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("grp", T.StringType()),
    T.StructField("converted", T.IntegerType()),
    T.StructField("order_value", MONEY),
])

SCHEMAS = {
    "customers": CUSTOMERS_SCHEMA,
    "products": PRODUCTS_SCHEMA,
    "orders": ORDERS_SCHEMA,
    "order_items": ORDER_ITEMS_SCHEMA,
    "ab_test_campaign": CAMPAIGN_SCHEMA,
}

COMPLETED = "completed"


class RetailTables:
    """The five relations of the retail model as lazy DataFrames.

    Each relation is given either as a DataFrame or as a zero-argument
    function that builds it; builders run on first access only, so a query
    pays planning time just for the relations it reads.
    """

    NAMES = ("customers", "products", "orders", "order_items", "campaign", "order_level")

    def __init__(self, customers, products, orders, order_items, campaign, order_level=None):
        if order_level is None:
            def order_level():
                from tillsight.plans.order_level import build_order_level
                return build_order_level(self.orders, self.order_items)
        self._src = dict(zip(self.NAMES, (customers, products, orders, order_items, campaign, order_level)))
        self._built: dict[str, DataFrame] = {}
        # derived results shared by several queries over the same tables (e.g. the RFM model)
        self.memo: dict[str, object] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            src = self._src[name]
            self._built[name] = src() if callable(src) and not isinstance(src, DataFrame) else src
        return self._built[name]

    customers = property(lambda self: self._get("customers"))
    products = property(lambda self: self._get("products"))
    orders = property(lambda self: self._get("orders"))
    order_items = property(lambda self: self._get("order_items"))
    campaign = property(lambda self: self._get("campaign"))
    # completed orders with their revenue: shared by most queries
    order_level = property(lambda self: self._get("order_level"))

    def with_order_level(self, order_level: DataFrame) -> "RetailTables":
        """The same model reading a precomputed order-level table (e.g. one
        written by ``write_order_level`` in an earlier job)."""
        return RetailTables(*(self._src[n] for n in self.NAMES[:-1]), order_level=order_level)

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "products": self.products,
            "orders": self.orders,
            "order_items": self.order_items,
            "ab_test_campaign": self.campaign,
        }
