"""The order level refreshed by month: only touched months are rewritten, and the result equals a full build."""

import datetime as dt
import os
import time

import pytest

from tillsight.sources.adapter import orders_of, order_items_of, read_driver_table, retail_from_driver
from tillsight.sources.refresh import manifest, read_refreshed, refresh, warehouse_facts
from tillsight.plans.order_level import build_order_level


class Source:
    """A folder of warehouse tables whose orders and lines come in files."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.target = spark, os.path.join(folder, "in"), os.path.join(folder, "out")
        spark.createDataFrame([(0, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{self.folder}/region.parquet")
        spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{self.folder}/nation.parquet")
        self.customers("AUTOMOBILE")

    def customers(self, segment):
        rows = [(c, f"c{c}", 0, 0.0, segment) for c in range(5)]
        self.spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/customer.parquet")

    def orders(self, name, rows):
        """rows: (order, status, date)"""
        rows = [(o, o % 5, st, 0.0, d and dt.datetime.fromisoformat(d), "x") for o, st, d in rows]
        df = self.spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/orders.parquet/{name}")

    def lines(self, name, rows):
        """rows: (order, extended price)"""
        df = self.spark.createDataFrame(rows, "l_orderkey long, l_extendedprice double").selectExpr(
            "l_orderkey", "1L AS l_partkey", "1L AS l_suppkey", "1 AS l_linenumber", "1D AS l_quantity", "l_extendedprice", "0D AS l_discount", "0D AS l_tax", "'' AS l_returnflag",
            "'' AS l_linestatus", "cast(NULL AS timestamp_ntz) AS l_shipdate")
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/lineitem.parquet/{name}")

    def remove(self, table, name):
        path = f"{self.folder}/{table}.parquet/{name}"
        for f in os.listdir(path):
            os.remove(os.path.join(path, f))
        os.rmdir(path)

    def refresh(self):
        return refresh(self.spark, warehouse_facts(self.spark, self.folder), self.target)

    def rows(self):
        return sorted(map(str, read_refreshed(self.spark, self.target).drop("order_month").collect()))

    def full(self):
        customers = retail_from_driver(self.spark, self.folder).customers
        find = lambda t: [os.path.join(p, f) for p, _, fs in os.walk(f"{self.folder}/{t}.parquet") for f in fs if f.endswith(".parquet")]
        raw = {t: read_driver_table(self.spark, self.folder, t, find(t)) for t in ("orders", "lineitem")}
        return sorted(map(str, build_order_level(orders_of(raw["orders"], customers), order_items_of(raw["lineitem"])).collect()))

    def files(self):
        out = {}
        for p, _, fs in os.walk(f"{self.target}/order_level"):
            for f in fs:
                if f.endswith(".parquet"):
                    out.setdefault(os.path.basename(p).removeprefix("order_month="), set()).add((f, os.stat(os.path.join(p, f)).st_mtime_ns))
        return out


@pytest.fixture()
def source(spark, scratch):
    s = Source(spark, scratch)
    s.orders("a", [(1, "F", "2024-01-05"), (2, "F", "2024-02-05"), (3, "O", "2024-02-06"), (4, "F", None)])
    s.orders("b", [(5, "F", "2024-03-05"), (6, "F", "2024-03-09")])
    s.lines("a", [(1, 10.0), (2, 20.0), (3, 30.0), (4, 40.0)])
    s.lines("b", [(5, 50.0), (5, 1.0), (9, 90.0), (2, 2.0)])  # 9 has no order yet, 6 no lines
    assert s.refresh().months is None
    return s


def changed_months(before, after):
    return {m for m in before.keys() | after.keys() if before.get(m) != after.get(m)}


def step(source, months):
    """One refresh rewrites ``months`` alone and gives the full build."""
    before = source.files()
    time.sleep(0.01)
    assert set(source.refresh().months) == months
    after = source.files()
    assert changed_months(before, after) <= months
    assert source.rows() == source.full()
    return before, after


def test_the_first_build_holds_everything(source):
    assert source.rows() == source.full() and len(source.rows()) == 4
    assert set(source.files()) == {"2024-01", "2024-02", "2024-03", "undated"}
    listed = {(r.table, r.order_month) for r in manifest(source.spark, source.target).collect()}
    assert ("items", "unmatched") in listed and ("orders", "undated") in listed


def test_without_changes_nothing_is_written(source):
    before = source.files()
    assert source.refresh().months == []
    assert source.files() == before


def test_an_added_file_rewrites_only_its_months(source):
    source.orders("c", [(7, "F", "2024-03-20"), (8, "F", "2024-04-01")])
    source.lines("c", [(7, 70.0), (8, 80.0)])
    before, after = step(source, {"2024-03", "2024-04"})
    assert changed_months(before, after) == {"2024-03", "2024-04"}


def test_late_lines_and_late_orders(source):
    source.lines("late", [(6, 60.0)])
    step(source, {"2024-03"})
    source.orders("late", [(9, "F", "2024-01-31")])  # its line came with the first batch
    step(source, {"2024-01"})
    assert len(source.rows()) == 6


def test_corrected_orders(source):
    source.orders("a", [(1, "F", "2024-01-05"), (2, "F", "2024-05-05"), (3, "O", "2024-06-06"), (4, "F", None)])  # moved to other months
    step(source, {"2024-01", "2024-02", "2024-05", "2024-06", "undated"})
    assert "2024-02" not in source.files()  # no rows are left
    source.orders("a", [(1, "P", "2024-01-05"), (2, "F", "2024-05-05"), (3, "F", "2024-06-06"), (4, "F", None)])  # 3 is completed now, 1 is not
    step(source, {"2024-01", "2024-05", "2024-06", "undated"})
    assert set(source.files()) == {"2024-03", "2024-05", "2024-06", "undated"}


def test_removed_files(source):
    source.remove("orders", "b")
    step(source, {"2024-03"})
    source.remove("lineitem", "a")
    step(source, {"2024-01", "2024-02", "undated"})
    source.orders("b", [(5, "F", "2024-03-05")])  # its lines are still there
    step(source, {"2024-03"})


def test_a_changed_dimension_rebuilds_everything(source):
    time.sleep(1.1)
    source.customers("BUILDING")
    assert source.refresh().months is None
    assert source.rows() == source.full()


def test_a_run_that_failed_before_its_manifest_is_repeated(source):
    source.lines("c", [(6, 60.0)])
    source.refresh()
    newest = max(os.listdir(f"{source.target}/manifest"))
    os.remove(f"{source.target}/manifest/{newest}/_SUCCESS")
    step(source, {"2024-03"})


def test_cli_refresh(spark, source, capsys):
    from tillsight.__main__ import main
    source.lines("c", [(6, 60.0)])
    assert main(["refresh", "--tables", source.folder, "--out", source.target]) == 0
    assert capsys.readouterr().out.strip().endswith("months: 2024-03")


def test_line_sums_go_by_file_number_and_keep_undated_orders_apart(spark, source, monkeypatch):
    from tillsight.sources import refresh as module
    kept, write = {}, module.written
    monkeypatch.setattr(module, "written", lambda df, name: kept.setdefault(name, write(df, name)))
    source.orders("a", [(1, "F", "2024-01-05"), (2, "F", None), (3, "O", "2024-02-01")])
    source.lines("a", [(1, 10.0), (2, 20.0), (3, 5.0), (9, 1.0)])
    source.lines("b", [(1, 7.0), (None, 2.0)])
    refresh(spark, warehouse_facts(spark, source.folder), source.target)
    assert [t for n, t in kept["order-file-sums"].dtypes if n != "revenue"] == ["bigint", "int"]  # no path travels with each order
    found = {(os.path.basename(os.path.dirname(r.file)), r.order_month) for r in manifest(spark, source.target).where("table = 'items'").collect()}
    assert found == {("a", "2024-01"), ("a", "undated"), ("a", "2024-02"), ("a", "unmatched"), ("a", "present"),
                     ("b", "2024-01"), ("b", "unmatched"), ("b", "present")}
    assert {r.order_id: float(r.order_revenue) for r in read_refreshed(spark, source.target).collect()} == {1: 17.0, 2: 20.0}
