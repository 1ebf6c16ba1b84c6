"""Duplicates by fingerprint and foreign keys in one scan per table."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillsight import shared
from tillsight.operators import quality
from tillsight.operators.keyfilter import bits_for, key_filter, may_hold
from tillsight.operators.quality import Reference, duplicate_rows, foreign_key_orphans, table_profile

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def plans(monkeypatch):
    """Executed plans of all written tables, in order."""
    seen, write = [], shared.written

    def recorded(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)
    monkeypatch.setattr(shared, "written", recorded)
    return seen


def lines(rng, n=3000):
    """Order lines where one product and one customer hold a third of all rows; some rows repeat."""
    rows = [(i, 7 if i % 3 else rng.randrange(50), 1 if i % 3 == 1 else rng.randrange(400), None if i % 11 == 0 else "x" * (i % 5)) for i in range(n)]
    return rows + rows[:37] + [rows[5]] * 400 + [(None, None, None, None)] * 3


COLUMNS = "order_id long, product_id long, customer_id long, note string"


@pytest.mark.parametrize("how", ["plain", "all collide", "filter"])
def test_duplicates_are_exact(spark, how, monkeypatch):
    rows = lines(random.Random(1))
    df = spark.createDataFrame(rows, COLUMNS)
    if how == "filter":
        monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
    forced = F.lit(1) if how == "all collide" else None
    want = sum(n - 1 for n in Counter(rows).values())
    assert duplicate_rows(df, forced).first().duplicate_rows == want == 37 + 400 + 2
    r = table_profile(df, "t", forced).first()
    assert (r.rows, r.null_cells, r.duplicate_rows) == (len(rows), sum(x is None for row in rows for x in row), want)


def test_values_that_are_null_in_other_places_differ(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", None), (None, "")], "x string, y string")
    assert df.select(quality.row_fingerprint(["x", "y"])).distinct().count() == 4
    assert duplicate_rows(df).first().duplicate_rows == 0


def test_only_rows_of_repeated_fingerprints_are_shuffled_whole(spark, scratch, plans):
    path = f"{scratch}/t"
    spark.createDataFrame(lines(random.Random(2)), COLUMNS).write.parquet(path)
    result = duplicate_rows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    first = dict(plans)["repeated-rows"]
    assert not any("note" in ln for ln in first.splitlines() if "Exchange" in ln)  # fingerprints only
    lines_ = result.splitlines()
    whole = next(i for i, ln in enumerate(lines_) if "Exchange hashpartitioning" in ln and "note" in ln)
    semi = next(i for i, ln in enumerate(lines_) if "BroadcastHashJoin" in ln and "LeftSemi" in ln)
    assert whole < semi  # the semi join stands below the shuffle of whole rows
    assert not any("Exchange hashpartitioning" in ln for ln in lines_[semi:])


def test_a_filter_never_loses_a_key(spark):
    keys = spark.range(0, 500).select((F.col("id") * 3).alias("k"))
    for bits in (64, bits_for(500)):
        words = key_filter(keys, "k", bits)
        tested = spark.range(0, 1500).select("id", may_hold(words, F.col("id"), bits).alias("maybe"))
        assert tested.where("id % 3 = 0 AND NOT maybe").count() == 0
        maybe = tested.where("id % 3 <> 0 AND maybe").count()
        assert maybe == 1000 if bits == 64 else maybe < 50


REFERENCES = [Reference("o", "c", "c", "c"), Reference("i", "o", "o", "o"), Reference("i", "p", "p", "p")]


def fk_tables(spark, rng):
    customers = [(i,) for i in range(0, 900, 2)] + [(None,)]
    products = [(f"P{i}",) for i in range(40)]
    orders = [(i, 4 if i % 3 else rng.randrange(1000)) for i in range(1200)] + [(None, 5), (3, None)]
    items = [(7 if i % 3 == 0 else rng.randrange(1300), "P1" if i % 3 else f"P{rng.randrange(44)}") for i in range(4000)] + [(None, None), (None, "P99")]
    frame = lambda rows, s: spark.createDataFrame(rows, s)
    tables = {"c": frame(customers, "c long"), "p": frame(products, "p string"), "o": frame(orders, "o long, c long"), "i": frame(items, "o long, p string")}
    have = lambda rows, at: {r[at] for r in rows}
    lost = lambda rows, at, owned: sum(r[at] is not None and r[at] not in owned for r in rows)
    return tables, [lost(orders, 1, have(customers, 0)), lost(items, 0, have(orders, 0)), lost(items, 1, have(products, 0))]


@pytest.mark.parametrize("bits", [None, 64, 1 << 12])
def test_orphans_are_exact_also_when_the_filter_always_says_maybe(spark, bits):
    tables, want = fk_tables(spark, random.Random(3))
    got = {(r.child_table, r.child_column): r.orphan_rows for r in foreign_key_orphans(tables, REFERENCES, bits).collect()}
    assert [got[r.child, r.column] for r in REFERENCES] == want and min(want) > 0


def test_references_travel_in_their_own_type_and_once_a_value(spark, monkeypatch):
    from tillsight import shared
    tables, want = fk_tables(spark, random.Random(3))
    kept, write = {}, shared.written
    monkeypatch.setattr(shared, "written", lambda df, name: kept.setdefault(name, write(df, name)))
    assert [r.orphan_rows for r in foreign_key_orphans(tables, REFERENCES).collect()] == want
    assert {n: dict(df.dtypes) for n, df in kept.items()} == {
        "keys-c": {"c": "bigint"}, "keys-p": {"p": "string"}, "keys-o": {"c": "bigint", "o": "bigint"}, "keys-i": {"o": "bigint", "p": "string"}}


def test_references_of_other_types_are_compared_as_text(spark):
    child = spark.createDataFrame([("1",), ("01",), ("x",), (None,)], "fk string")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "pk int")
    assert foreign_key_orphans({"c": child, "p": parent}, [Reference("c", "fk", "p", "pk")]).first().orphan_rows == 2
    short = spark.createDataFrame([(1,), (7,)], "fk short")
    assert foreign_key_orphans({"c": short, "p": parent}, [Reference("c", "fk", "p", "pk")]).first().orphan_rows == 1


def test_references_without_orphans_and_empty_tables(spark):
    tables, _ = fk_tables(spark, random.Random(3))
    empty = {k: v.limit(0) for k, v in tables.items()}
    assert [r.orphan_rows for r in foreign_key_orphans(empty, REFERENCES).collect()] == [0, 0, 0]
    only = {**tables, "c": tables["c"].limit(0)}
    assert sum(r.orphan_rows for r in foreign_key_orphans(only, REFERENCES[:1]).collect()) == 1201


def test_a_table_may_refer_to_itself(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id long, parent long")
    assert foreign_key_orphans({"t": df}, [Reference("t", "parent", "t", "id")]).first().orphan_rows == 1


def test_every_table_is_scanned_once(spark, plans):
    from tillsight.plans.quality import REFERENCES as RETAIL
    from tillsight.sources.adapter import retail_from_driver
    t = retail_from_driver(spark, SF)
    tables = {"customers": t.customers, "products": t.products, "orders": t.orders, "order_items": t.order_items}
    result = foreign_key_orphans(tables, RETAIL[:3])
    ran = "\n".join(p for _, p in plans) + result._jdf.queryExecution().executedPlan().toString()
    for name in ("customer", "part", "orders", "lineitem"):
        assert len(re.findall(rf"FileScan parquet [^\n]*/{name}\.parquet", ran)) == 1
