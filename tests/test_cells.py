"""Roll-ups from stored sketches against exact counts, and the dashboard's long rows against its document."""

import datetime as dt
import json
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_fixtures import d, make_tables, money, simple_orders
from tillsight.plans import cells, report

SF = "/root/testdata/sf0.001"


def shop(spark, orders, customers):
    """orders: (order, customer, day, revenue); customers: id -> (region, channel), copied onto the orders."""
    rows = [(o, c, d(day), "completed", *customers[c]) for o, c, day, _ in orders]
    return make_tables(spark, [(c, d("2024-01-01"), *where, 0.5) for c, where in customers.items()], [("P1", "A", money(1), money(1), "A-1")],
                       rows, [(o, "P1", 1, money(v), money(v)) for o, _, _, v in orders])


def test_counts_of_quarters_come_from_the_cells(spark):
    customers = {"a": ("W", "Email"), "b": ("W", "Direct"), "c": ("S", "Email")}
    t = shop(spark, [("1", "a", "2024-01-05", 1), ("2", "a", "2024-03-05", 1), ("3", "b", "2024-02-01", 1), ("4", "a", "2024-04-01", 5), ("5", "c", "2024-01-01", 2),
                     ("6", "c", "2024-07-01", 2), ("7", "b", "2025-01-01", 9)], customers)
    df = cells.customers_by_quarter_region(t)
    got = {(r.order_quarter, r.region): (r.orders, float(r.revenue), r.customers, r.returning_customers) for r in df.collect()}
    assert got == {("2024-Q1", "W"): (3, 3.0, 2, 0), ("2024-Q2", "W"): (1, 5.0, 1, 1), ("2025-Q1", "W"): (1, 9.0, 1, 0),
                   ("2024-Q1", "S"): (1, 2.0, 1, 0), ("2024-Q3", "S"): (1, 2.0, 1, 0)}
    assert df.inputFiles() and all("order-cells" in f for f in df.inputFiles())  # the orders are not read again


def test_distinct_counts_stay_within_their_error(spark):
    rng = random.Random(2)
    lg, orders, seen = 9, [], defaultdict(set)
    for i in range(20_000):
        c, month = rng.randrange(9000), rng.randint(1, 6)
        orders.append((i, c, dt.date(2024, month, 1 + i % 28), "W" if c % 3 else "S", "Email" if i % 2 else "Direct"))
        seen[(month - 1) // 3 + 1, "W" if c % 3 else "S"].add(c)

    class Tables:
        memo = {}
        order_level = spark.createDataFrame(orders, "order_id long, customer_id long, order_date date, region string, acquisition_channel string").withColumn("order_revenue", F.lit(1).cast("decimal(12,2)"))
    for r in cells.customers_by_quarter_region(Tables, lg).collect():
        q = int(r.order_quarter[-1])
        exact = len(seen[q, r.region])
        assert exact > 2 ** lg and abs(r.customers / exact - 1) < 4 / math.sqrt(2 ** lg)
        if q == 2:
            assert abs(r.returning_customers - len(seen[1, r.region] & seen[2, r.region])) < 4 / math.sqrt(2 ** lg) * len(seen[1, r.region] | seen[2, r.region])


@pytest.mark.parametrize("k", [200, 4096])
def test_quartiles_stay_within_their_rank_error(spark, k):
    rng = np.random.default_rng(3)
    customers = {f"c{i}": ("W" if i % 4 else "S", ("Email", "Direct", "Ads")[i % 3]) for i in range(4000)}
    t = shop(spark, [(f"o{i}", f"c{i}", "2024-01-01", round(float(v), 2)) for i, v in enumerate(rng.lognormal(4, 1, 4000))], customers)
    values = defaultdict(list)
    for r in t.order_level.collect():
        values[r.region].append(float(r.order_revenue))
    bound = 2.3 / k ** 0.94 if k < 4000 else 1 / 1000
    rows = {r.region: r for r in cells.value_quartiles_by_region(t, k).collect()}
    for region, vals in values.items():
        vals = np.sort(vals)
        for p, edge in ((0.25, rows[region].q25), (0.5, rows[region].q50), (0.75, rows[region].q75)):
            assert abs(np.searchsorted(vals, edge, "right") / len(vals) - p) <= 2 * bound + 1 / len(vals)
    scores = cells.value_scores_by_region(t, k).groupBy("region", "value_score").count().collect()
    assert {(r.region, r.value_score) for r in scores} == {(g, s) for g in "WS" for s in (1, 2, 3, 4)}


def test_sections_hold_what_the_document_holds(spark):
    from tillsight.plans.registry import retail_model
    t = retail_model(spark, SF)
    doc = json.loads(report.dashboard_json(t).first().document)
    rows = defaultdict(dict)
    for r in report.dashboard_sections(t).orderBy("position").collect():
        rows[r.section][r.row_label, r.column_label] = r.value
    assert [k for k, _ in rows["monthly"]] == doc["monthly"]["labels"] and list(rows["monthly"].values()) == doc["monthly"]["values"]
    assert [k for k, _ in rows["category"]] == doc["category"]["labels"] and list(rows["category"].values()) == doc["category"]["values"]
    grid, pct = doc["region_channel"], doc["cohort"]
    flat = lambda names, others, matrix: {(a, b): v for a, row in zip(names, matrix) for b, v in zip(others, row) if v is not None}
    assert flat(grid["regions"], grid["channels"], grid["matrix"]) == rows["region_channel"]
    assert flat(pct["cohorts"], [f"M+{p}" for p in pct["periods"]], pct["matrix"]) == rows["cohort"]
    assert {(s["segment"], k): v for s in doc["rfm"] for k, v in s.items() if k != "segment"} == rows["rfm"]
    assert {k: float(v) for k, v in doc["kpis"].items()} == {c: v for (_, c), v in rows["kpis"].items()}
    assert {k: float(v) for k, v in doc["ab_test"].items()} == {c: v for (_, c), v in rows["ab_test"].items() if v is not None}


def test_texts_and_heat_of_the_sections(spark):
    t = simple_orders(spark, [("o1", "a", "2024-01-05", "completed", 1234500.0), ("o2", "b", "2024-01-07", "completed", 10.0), ("o3", "a", "2024-02-07", "completed", 10.0)])
    rows = {(r.section, r.column_label): r for r in report.dashboard_sections(t).collect()}
    assert rows["region_channel_k", "Email"].display == "$1,235K" and rows["region_channel_k", "Email"].value == 1235.0
    assert (rows["cohort", "M+1"].value, rows["cohort", "M+1"].display, rows["cohort", "M+1"].heat) == (50.0, "50%", 0.5)
