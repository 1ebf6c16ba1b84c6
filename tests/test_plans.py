"""Physical plan checks: no Python in the data path, pushdown, semi/anti joins,
bounded top-k before the shuffle."""

import re

import pytest

import __spark_entry__ as entry
from tillsight.plans import registry, sales

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_in_the_retail_queries(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    for node in ("PythonUDF", "EvalPython", "InPandas", "InArrow"):
        assert node not in p


def test_the_completed_filter_reaches_the_reader(spark):
    from tillsight.plans.order_level import completed_orders
    from tillsight.sources.adapter import retail_from_driver
    t = retail_from_driver(spark, SF)
    for df in (t.order_level, completed_orders(t.orders), sales.category_revenue(t)):
        pushed = [ln for ln in df._jdf.queryExecution().executedPlan().toString().splitlines() if "o_orderstatus" in ln and "PushedFilters" in ln]
        assert pushed and all(re.search(r"PushedFilters: \[[^]]*Equal(To|NullSafe)\(o_orderstatus,F\)", ln) for ln in pushed)


def test_top_k_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["top_customers_by_region"](spark, SF))


def test_churn_reads_the_orders_once_with_range_pushdown(spark):
    p = entry.queries()["churn_candidates"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in p.splitlines() if "FileScan" in ln and "o_orderdate" in ln]
    assert len(scans) == 1 and "GreaterThanOrEqual(o_orderdate" in scans[0] and "LeftSemi" in p


def test_category_plans_shuffle_sums_per_product_not_lines(spark):
    from tillsight.sources.adapter import retail_from_driver
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        revenue, margin = (f(retail_from_driver(spark, SF))._jdf.queryExecution().executedPlan().toString() for f in (sales.category_revenue, sales.category_margin))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = lambda p, *words: [ln for ln in p.splitlines() if "Exchange hashpartitioning(" in ln and any(w in ln.split("hashpartitioning(")[1].split(",")[0] for w in words)]
    below = lambda p, ln: p.splitlines()[p.splitlines().index(ln) + 1]
    # lines meet products only as sums; the other side is the catalogue
    assert all("partial_sum" in below(revenue, ln) or "category" in below(revenue, ln) for ln in shuffles(revenue, "product_id"))
    assert len(shuffles(revenue, "order_id")) == 2  # lines and completed orders, once each
    assert any("partial_sum" in below(margin, ln) for ln in shuffles(margin, "product_id"))


def test_order_revenue_is_partially_aggregated_before_the_join(spark):
    from tillsight.sources.adapter import retail_from_driver
    t = retail_from_driver(spark, SF)
    p = t.order_level._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in p


def test_scan_reads_only_needed_columns(spark):
    df = entry.queries()["category_revenue"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "l_discount" not in p and "l_shipdate" not in p and "p_retailprice" not in p


def test_order_level_reads_no_products(spark):
    from tillsight.sources.adapter import retail_from_driver
    p = plan(retail_from_driver(spark, SF).order_level)
    assert "part.parquet" not in p and "p_partkey" not in p
