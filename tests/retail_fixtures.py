"""Hand-made retail tables for micro-fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillsight.sources.model import SCHEMAS, RetailTables


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def make_tables(spark, customers=(), products=(), orders=(), items=(), campaign=()) -> RetailTables:
    def df(name, rows):
        return spark.createDataFrame(list(rows), SCHEMAS[name])
    return RetailTables(df("customers", customers), df("products", products), df("orders", orders),
                        df("order_items", items), df("ab_test_campaign", campaign))


def simple_orders(spark, rows, customers=None, category="Electronics"):
    """rows: (order_id, customer_id, date, status, revenue); one line of quantity 1 per order."""
    custs = customers or sorted({(r[1], d("2024-01-01"), "West", "Email", 0.5) for r in rows})
    prods = [("P1", category, money(1), money(0.5), "ELEC-0001")]
    orders = [(oid, cid, d(day), st, "West", "Email") for oid, cid, day, st, _ in rows]
    items = [(oid, "P1", 1, money(rev), money(rev / 2)) for oid, _, _, _, rev in rows]
    return make_tables(spark, custs, prods, orders, items)
