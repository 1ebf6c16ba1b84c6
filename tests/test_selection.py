"""Rows at positions of an order, RFM cuts and exact samples without a sort of the table."""

import hashlib
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from retail_fixtures import simple_orders
from tillsight.operators import sampling, selection
from tillsight.operators.sampling import sample_exact_n
from tillsight.operators.selection import order_statistics
from tillsight.plans import rfm

WIDE_NODES = ("Sort", "rangepartitioning", "Window", "Exchange")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def narrow(monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 40)
    monkeypatch.setattr(selection, "RANGES", 5)
    monkeypatch.setattr(sampling, "SMALL", 20)
    monkeypatch.setattr(sampling, "DIGITS", 1)


@pytest.mark.parametrize("ids", ["long", "string"])
def test_positions_equal_the_sorted_rows(spark, narrow, ids):
    rng = random.Random(4)
    rows = [(1 if rng.random() < 0.9 else rng.randint(1, 40), i if ids == "long" else f"C{i * 7919 % 3000:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, f"f long, id {ids}").repartition(7)
    want = sorted(rows)
    positions = [1, 2, 750, 1500, 2250, 2700, 2999, 3000, 0, 3001]
    got = order_statistics(df, ["f", "id"], positions)
    assert {p: tuple(k) for p, k in got.items()} == {p: want[p - 1] for p in positions if 1 <= p <= 3000}


def test_positions_among_equal_keys_and_nulls(spark, narrow):
    df = spark.createDataFrame([(5,)] * 500 + [(None,)] * 100 + [(7,)] * 3, "x long")
    got = order_statistics(df, ["x"], [1, 100, 101, 600, 601, 603])
    assert [got[p].x for p in (1, 100, 101, 600, 601, 603)] == [None, None, 5, 5, 7, 7]
    assert order_statistics(df.limit(0), ["x"], [1]) == {}


def test_frequency_scores_when_nine_in_ten_customers_bought_once(spark, narrow):
    rng = random.Random(9)
    rows = []
    for c in range(400):
        for k in range(1 if c % 10 else rng.randint(2, 6)):
            rows.append((f"o{c}-{k}", f"c{c * 37 % 400:03d}", f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", "completed", float(rng.randint(1, 9999))))
    model = rfm.RfmModel(simple_orders(spark, rows))
    freq = Counter(r[1] for r in rows)
    order = sorted(freq, key=lambda c: (freq[c], c))
    want = dict(zip(order, pd.qcut(pd.Series(range(1, len(order) + 1)), 4, labels=[1, 2, 3, 4]).astype(int), strict=True))
    got = {r.customer_id: r.f_score for r in model._score().collect()}
    assert got == want
    scored = plan(model._score())
    assert not any(n in scored.split("Subqueries")[0] for n in ("Sort ", "rangepartitioning", "Window"))


def test_no_customers(spark):
    t = simple_orders(spark, [("o1", "c1", "2024-01-01", "returned", 1.0)])
    assert rfm.rfm_scores(t).count() == 0
    assert rfm.rfm_segment_summary(t).count() == 0


@pytest.mark.parametrize("n", [0, 1, 17, 300, 799, 800, 900])
def test_a_sample_is_a_filter_and_keeps_the_same_rows(spark, narrow, n):
    df = spark.range(0, 800).withColumnRenamed("id", "k")
    got = sample_exact_n(df, "k", n, "s")
    want = sorted(range(800), key=lambda k: (hashlib.md5(f"{k}:s".encode()).hexdigest(), k))[:n]
    assert sorted(r.k for r in got.collect()) == sorted(want)
    if n:
        assert not any(node in plan(got) for node in WIDE_NODES)


def test_a_sample_of_a_table_with_a_hot_key_and_nulls(spark, narrow):
    rows = [(7,)] * 400 + [(i,) for i in range(300)] + [(None,)] * 5
    df = spark.createDataFrame(rows, "k long")
    order = sorted(rows, key=lambda r: (r[0] is not None, hashlib.md5(f"{r[0]}:s".encode()).hexdigest() if r[0] is not None else "", r[0] or 0))
    for n in (3, 5, 200, 500, 704):
        assert Counter(r.k for r in sample_exact_n(df, "k", n, "s").collect()) == Counter(r[0] for r in order[:n])
