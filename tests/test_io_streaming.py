import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from retail_fixtures import money, simple_orders
from tillsight.plans import sales
from tillsight.plans.order_level import order_level
from tillsight.sources.files import read_csv_table, read_retail_csv, save_table, write_csv, write_order_level
from tillsight.streaming import monthly_revenue_stream


def test_csv_roundtrip_with_explicit_schemas(spark, scratch):
    t = simple_orders(spark, [("o1", "c1", "2024-01-10", "completed", 100.0),
                              ("o2", "c2", "2024-02-10", "completed", 50.0)])
    for name, df in t.as_dict().items():
        out = df if name != "ab_test_campaign" else df.withColumnRenamed("grp", "group")
        write_csv(out, os.path.join(scratch, f"{name}.csv"))
    back = read_retail_csv(spark, scratch)
    assert back.orders.schema == t.orders.schema
    assert sorted(tuple(r) for r in sales.monthly_revenue_growth(back).collect()) == \
        sorted(tuple(r) for r in sales.monthly_revenue_growth(t).collect())


def test_csv_columns_are_found_by_name(spark, scratch):
    path = os.path.join(scratch, "products.csv")
    with open(path, "w") as f:
        f.write("unit_price,shelf,category,product_id,product_name,unit_cost\n9.50,A3,Toys,PROD0001,Kite,4.25\n")
    row = read_csv_table(spark, path, "products").collect()[0].asDict()
    assert row == {"product_id": "PROD0001", "category": "Toys", "unit_price": money("9.50"), "unit_cost": money("4.25"), "product_name": "Kite"}
    with open(path, "w") as f:
        f.write("product_id,category\nPROD0001,Toys\n")
    with pytest.raises(ValueError, match="unit_price"):
        read_csv_table(spark, path, "products")


def test_shared_tables_follow_their_input_and_are_deleted(spark, scratch):
    from tillsight.plans import registry
    from tillsight.session import checkpoint_dir
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no warehouse tables here")
    data = os.path.join(scratch, "tables")
    os.mkdir(data)
    for name in ("region", "nation", "customer", "part"):
        shutil.copy(f"{sf}/{name}.parquet", data)
    for name in ("orders", "lineitem"):
        os.mkdir(f"{data}/{name}.parquet")
        shutil.copy(f"{sf}/{name}.parquet", f"{data}/{name}.parquet/a.parquet")
    qs = registry.queries()
    first = qs["kpis"](spark, data).collect()[0]
    assert qs["kpis"](spark, data).collect()[0] == first
    trend = qs["monthly_revenue_filled"](spark, data)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in trend.splitlines() if "FileScan" in ln]
    assert scans and all("ReadSchema: struct<order_date:date,order_revenue:decimal" in ln for ln in scans)
    shutil.copy(f"{sf}/lineitem.parquet", f"{data}/lineitem.parquet/b.parquet")  # every line twice
    assert qs["kpis"](spark, data).collect()[0].total_revenue == pytest.approx(2 * first.total_revenue)
    for _ in range(2):
        qs["customers_by_signup"](spark, data).count()
        qs["rfm_top_segment"](spark, data).count()
    folder = checkpoint_dir(spark).removeprefix("file:")
    assert any(f.startswith("tillsight-") for f in os.listdir(folder))
    registry.release(spark)
    assert not any(f.startswith("tillsight-") for f in os.listdir(folder))


def test_order_level_partitioned_by_month_prunes(spark, scratch):
    t = simple_orders(spark, [("o1", "c1", "2024-01-10", "completed", 100.0),
                              ("o2", "c2", "2024-02-10", "completed", 50.0)])
    path = os.path.join(scratch, "order_level")
    write_order_level(order_level(t.orders, t.order_items), path)
    df = spark.read.parquet(path).where(F.col("order_month") == F.lit("2024-02-01").cast("date"))
    assert df.count() == 1
    assert "PartitionFilters: [isnotnull(order_month" in df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_table_join_has_no_exchange(spark):
    a = spark.range(0, 1000).selectExpr("id AS order_id", "id % 7 AS v")
    save_table(a, "ol_bucketed_a", bucket_by=["order_id"], buckets=4, sort_by=["order_id"])
    save_table(a, "ol_bucketed_b", bucket_by=["order_id"], buckets=4, sort_by=["order_id"])
    j = spark.table("ol_bucketed_a").join(spark.table("ol_bucketed_b"), "order_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 1000
        assert "Exchange" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_streaming_monthly_refresh_equals_batch(spark, scratch):
    t = simple_orders(spark, [("o1", "c1", "2024-01-10", "completed", 100.0),
                              ("o2", "c2", "2024-02-10", "completed", 50.0),
                              ("o3", "c2", "2024-02-12", "completed", 25.0)])
    ol = order_level(t.orders, t.order_items)
    src, out, ck = (os.path.join(scratch, x) for x in ("src", "out", "ck"))
    ol.where("order_id = 'o1'").write.parquet(os.path.join(src, "batch1"))
    q = monthly_revenue_stream(spark, src + "/*", out, ck, schema="order_id string, customer_id string, "
                               "order_date date, region string, acquisition_channel string, "
                               "order_revenue decimal(33,2)")
    q.awaitTermination(120)
    ol.where("order_id <> 'o1'").write.parquet(os.path.join(src, "batch2"))
    q = monthly_revenue_stream(spark, src + "/*", out, ck, schema="order_id string, customer_id string, "
                               "order_date date, region string, acquisition_channel string, "
                               "order_revenue decimal(33,2)")
    q.awaitTermination(120)
    got = {r.month: float(r.revenue) for r in spark.read.parquet(out).collect()}
    assert got == {dt.date(2024, 1, 1): 100.0, dt.date(2024, 2, 1): 75.0}


def test_cli_runs_on_csv_exports_and_exports_reports(spark, scratch):
    from retail_fixtures import d, make_tables, money
    from tillsight.__main__ import main
    from tillsight.plans.export import export_reports
    custs = [(f"CUST{i:05d}", d("2024-01-01"), "West" if i % 2 else "South", "Email", 0.5) for i in range(1, 9)]
    prods = [("PROD0001", "Electronics", money(10), money(4), "ELEC-0001")]
    orders, items, camp = [], [], []
    for i in range(1, 9):
        for m in range(1, 1 + i % 4 + 1):
            oid = f"ORD{i:03d}{m:02d}"
            orders.append((oid, f"CUST{i:05d}", d(f"2024-{m:02d}-1{i % 9}"), "completed", "West", "Email"))
            items.append((oid, "PROD0001", i, money(10), money(4)))
        camp.append((f"CUST{i:05d}", "control" if i % 2 else "variant", i % 3 == 0, money(25 if i % 3 == 0 else 0)))
    t = make_tables(spark, custs, prods, orders, items, [(a, b, int(c), e) for a, b, c, e in camp])
    data = os.path.join(scratch, "data")
    for name, df in t.as_dict().items():
        out = df if name != "ab_test_campaign" else df.withColumnRenamed("grp", "group")
        write_csv(out.coalesce(1), os.path.join(data, f"{name}.csv"))
    assert main(["run", "rfm_segment_summary", "--csv", data, "--out", os.path.join(scratch, "seg"),
                 "--format", "parquet"]) == 0
    assert spark.read.parquet(os.path.join(scratch, "seg")).count() >= 1
    assert main(["run", "customer_codes", "--csv", data, "--show", "3"]) == 0
    written = export_reports(read_retail_csv(spark, data), os.path.join(scratch, "exports"))
    wide = spark.read.option("header", True).csv(written["cohort_retention.csv"])
    assert wide.columns[:2] == ["cohort_month", "0"]
    assert spark.read.text(written["data.json"]).count() == 1
    # a later job reuses the written order-level table
    assert main(["run", "kpis", "--csv", data, "--order-level", written["order_level"],
                 "--out", os.path.join(scratch, "kpis"), "--format", "json"]) == 0
    k1 = spark.read.json(os.path.join(scratch, "kpis")).collect()[0]
    k2 = sales.kpis(read_retail_csv(spark, data)).collect()[0]
    assert (k1.total_orders, k1.total_revenue) == (k2.total_orders, float(k2.total_revenue))


def test_sql_over_registered_views(spark):
    from tillsight.sources.views import register_views
    t = simple_orders(spark, [("o1", "c1", "2024-01-10", "completed", 100.0),
                              ("o2", "c2", "2024-02-10", "returned", 50.0),
                              ("o3", "c2", "2024-02-12", "completed", 25.0)])
    register_views(spark, t, prefix="t_")
    rows = spark.sql("""
        SELECT date_format(o.order_date, 'yyyy-MM') AS m, SUM(oi.quantity * oi.unit_price) AS revenue
        FROM t_orders o JOIN t_order_items oi ON oi.order_id = o.order_id
        WHERE o.status = 'completed' GROUP BY 1 ORDER BY 1""").collect()
    assert [(r.m, float(r.revenue)) for r in rows] == [("2024-01", 100.0), ("2024-02", 25.0)]
    assert spark.table("t_order_level").count() == 2


def test_cli_on_warehouse_tables(spark, scratch):
    from tillsight.__main__ import main
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no warehouse tables here")
    out = os.path.join(scratch, "top")
    assert main(["run", "top_customers_by_region", "--tables", sf, "--out", out, "--format", "parquet"]) == 0
    rows = spark.read.parquet(out).collect()
    assert rows and all(r.region_rank <= 5 for r in rows)
    assert main(["list"]) == 0
