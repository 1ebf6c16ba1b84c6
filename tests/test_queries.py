"""Every registered query against its DuckDB oracle on the smallest driver data,
plus whole-data invariants."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _key(row):
    return tuple((x is None, "" if x is None else (round(x, 6) if isinstance(x, float) else x)) for x in row)


def assert_same_rows(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if isinstance(x, float) or isinstance(y, float):
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9)
            else:
                assert x == y


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_month", "revenue", "revenue_change", "pct_change"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    from tillsight.plans.registry import plans  # the retail queries; those of the optional operators are tested with them
    no_sql = set(plans()) - set(entry.oracle_sql())
    assert no_sql == {"dashboard_dataset"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle_can_be_bound_as_a_view(con, name):
    con.execute(f"CREATE OR REPLACE TEMP VIEW bound AS {entry.oracle_sql()[name]}")
    assert con.execute("SELECT count(*) FROM (DESCRIBE bound)").fetchone()[0] == len(con.execute(entry.oracle_sql()[name]).description)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = df.columns
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=_key)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [x[0] for x in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert_same_rows(got, want)


def test_revenue_invariants(spark):
    q = entry.queries()
    total = q["kpis"](spark, SF).collect()[0].total_revenue
    months = sum(r.revenue for r in q["monthly_revenue_growth"](spark, SF).collect())
    cats = sum(r.revenue for r in q["category_revenue"](spark, SF).collect())
    cells = sum(r.revenue for r in q["region_channel_long"](spark, SF).collect())
    segs = q["rfm_segment_summary"](spark, SF).collect()
    for v in (months, cats, cells, sum(r.total_revenue for r in segs)):
        assert v == pytest.approx(total, rel=1e-9, abs=1.0)
    scores = q["rfm_scores"](spark, SF)
    assert scores.count() == scores.select("customer_id").distinct().count() == sum(r.customers for r in segs)
    ret = q["purchase_cohort_retention"](spark, SF).where("period = 0").collect()
    assert all(r.retention == 1.0 for r in ret)


def test_dashboard_document(spark):
    import json
    doc = json.loads(entry.queries()["dashboard_dataset"](spark, SF).collect()[0].document)
    assert set(doc) == {"monthly", "category", "region_channel", "rfm", "cohort", "ab_test", "kpis"}
    assert len(doc["monthly"]["labels"]) == len(doc["monthly"]["values"])
    assert len(doc["region_channel"]["matrix"]) == len(doc["region_channel"]["regions"])
    assert all(len(row) == len(doc["cohort"]["periods"]) for row in doc["cohort"]["matrix"])
    assert sum(doc["monthly"]["values"]) == pytest.approx(doc["kpis"]["total_revenue"], abs=1.0)
