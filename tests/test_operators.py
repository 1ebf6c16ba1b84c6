import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillsight.functions.numeric import round_float_half_even, round_sql
from tillsight.functions.stats import normal_cdf, two_sided_p
from tillsight.operators.gapfill import fill_month_gaps
from tillsight.operators.quantiles import (bin_score, discrete_quantiles, exact_quantiles,
                                          rank_quantile_edges)
from tillsight.operators.ranking import ordinal_rank, top_k_per_group
from tillsight.operators.sampling import assign_arm, hash_fraction_member, sample_exact_n
from tillsight.operators.shares import share_of_max, share_of_total


def test_ordinal_rank_matches_sorted_position_with_hot_key(spark):
    rng = random.Random(3)
    # one frequency value holds about a third of all rows
    rows = [(i, 1 if i % 3 == 0 else rng.randint(1, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "customer_id long, frequency long")
    got = {r.customer_id: r.ordinal for r in ordinal_rank(df, ["frequency", "customer_id"]).collect()}
    expected = {cid: pos + 1 for pos, (cid, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == expected


def test_ordinal_rank_pandas_first_method(spark):
    rows = [(i, f) for i, f in enumerate([3, 1, 2, 1, 3, 3, 2, 1])]
    df = spark.createDataFrame(rows, "customer_id long, frequency long")
    got = sorted((r.customer_id, r.ordinal) for r in ordinal_rank(df, ["frequency", "customer_id"]).collect())
    pdf = pd.DataFrame(rows, columns=["customer_id", "frequency"])
    expected = list(zip(pdf.customer_id, pdf.frequency.rank(method="first").astype(int)))
    assert got == sorted(expected)


@pytest.mark.parametrize("n", [1, 2, 5, 145, 1000])
def test_exact_quantiles_match_numpy(spark, n):
    rng = random.Random(n)
    vals = [round(rng.uniform(0, 5000), 2) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x").collect()[0].edges
    want = np.quantile(np.array(vals), [0.25, 0.5, 0.75])
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-9)


def test_discrete_quantiles_equal_exact_on_integers(spark):
    rng = random.Random(7)
    vals = [rng.randint(1, 700) for _ in range(997)]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    a = discrete_quantiles(df, "x").collect()[0].edges
    b = exact_quantiles(df, "x").collect()[0].edges
    assert a == b == list(np.quantile(np.array(vals, dtype=float), [0.25, 0.5, 0.75]))


@pytest.mark.parametrize("n", [145, 1425, 3930, 14434])
def test_rank_quartiles_match_qcut_not_ntile(spark, n):
    """qcut on ranks 1..n; bin sizes differ from ntile when n % 4 in (2, 3)."""
    df = spark.range(1, n + 1).withColumnRenamed("id", "rank")
    scored = df.select(bin_score(F.col("rank"), rank_quantile_edges(F.lit(n))).alias("s"))
    got = {r.s: r["count"] for r in scored.groupBy("s").count().collect()}
    want = pd.Series(pd.qcut(pd.Series(range(1, n + 1)), 4, labels=[1, 2, 3, 4]).astype(int)).value_counts().to_dict()
    assert got == want


def test_qcut_scores_match_pandas(spark):
    rng = random.Random(11)
    vals = [round(rng.lognormvariate(7, 1), 2) for _ in range(1425)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    edges = exact_quantiles(df, "x").select("edges").scalar()
    got = [r.s for r in df.select("id", bin_score(F.col("x"), edges).alias("s")).orderBy("id").collect()]
    want = list(pd.qcut(pd.Series(vals), 4, labels=[1, 2, 3, 4]).astype(int))
    assert got == want
    got_desc = [r.s for r in df.select("id", bin_score(F.col("x"), edges, descending=True).alias("s"))
                .orderBy("id").collect()]
    assert got_desc == list(pd.qcut(pd.Series(vals), 4, labels=[4, 3, 2, 1]).astype(int))


def test_duplicate_edges_keep_right_closed_bins(spark):
    """pandas raises on duplicate edges; here the bins stay right-closed and may be empty."""
    vals = [1, 1, 1, 1, 2, 3]
    with pytest.raises(ValueError):
        pd.qcut(pd.Series(vals), 4, labels=[1, 2, 3, 4])
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    edges = exact_quantiles(df, "x").select("edges").scalar()
    got = [r.s for r in df.select(bin_score(F.col("x"), edges).alias("s")).collect()]
    assert sorted(got) == [1, 1, 1, 1, 4, 4]


def test_normal_cdf_against_math_erf(spark):
    zs = [0.0, 0.1, -0.5, 1.0, 1.481, -1.96, 2.5, 4.0, -6.0, 9.0, 12.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = df.select(normal_cdf(F.col("z")).alias("c"), two_sided_p(F.col("z")).alias("p")).collect()
    for z, row in zip(zs, got):
        phi = 0.5 * (1 + math.erf(z / math.sqrt(2)))
        assert row.c == pytest.approx(phi, abs=1e-14)
        assert row.p == pytest.approx(2 * (1 - 0.5 * (1 + math.erf(abs(z) / math.sqrt(2)))), abs=1e-14)


def test_rounding_regimes(spark):
    """pandas path rounds half to even on the double, SQL path half away on decimals."""
    df = spark.createDataFrame([(0.0625, 52.25)], "a double, b double")
    r = df.select(round_float_half_even(F.col("a"), 3).alias("a3"), round_float_half_even(F.col("b"), 1).alias("b1"),
                  round_sql(F.col("a").cast("decimal(10,4)"), 3).alias("a3u"),
                  round_sql(F.col("b").cast("decimal(10,2)"), 1).alias("b1u")).collect()[0]
    assert (r.a3, r.b1) == (0.062, 52.2) == (round(np.float64(0.0625), 3), round(np.float64(52.25), 1))
    assert (float(r.a3u), float(r.b1u)) == (0.063, 52.3)
    rng = random.Random(5)
    xs = [rng.uniform(-1000, 1000) for _ in range(2000)] + [k / 8 for k in range(-40, 40)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(
        round_float_half_even(F.col("x"), 2).alias("r")).collect()
    assert [g.r for g in got] == [float(np.round(np.float64(x), 2)) for x in xs]


def test_fill_month_gaps_per_group(spark):
    import datetime as dt
    rows = [("a", dt.date(2024, 1, 1), 5), ("a", dt.date(2024, 3, 1), 7), ("b", dt.date(2024, 2, 1), 1)]
    df = spark.createDataFrame(rows, "g string, month date, v long")
    got = sorted(tuple(r) for r in fill_month_gaps(df, "month", ["v"], ["g"]).collect())
    assert got == [("a", dt.date(2024, 1, 1), 5), ("a", dt.date(2024, 2, 1), 0), ("a", dt.date(2024, 3, 1), 7),
                   ("b", dt.date(2024, 2, 1), 1)]


def test_top_k_keeps_rank_ties(spark):
    """RANK gives 1,1,3 and <= k may return more than k rows."""
    rows = [("r", "c1", 10.0), ("r", "c2", 10.0), ("r", "c3", 5.0), ("r", "c4", 1.0)]
    df = spark.createDataFrame(rows, "region string, c string, v double")
    got = sorted((r.c, r.rank) for r in top_k_per_group(df, ["region"], [F.desc("v")], 1).collect())
    assert got == [("c1", 1), ("c2", 1)]
    got3 = sorted(r["rank"] for r in top_k_per_group(df, ["region"], [F.desc("v")], 3).collect())
    assert got3 == [1, 1, 3]


def test_shares(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    got = {r.k: (r.s, r.m) for r in df.select("k", share_of_total(df, "v").alias("s"),
                                               share_of_max(df, "v").alias("m")).collect()}
    assert got == {"a": (25.0, 1 / 3), "b": (75.0, 1.0)}


def test_sampling_is_exact_and_matches_brute_force(spark):
    import hashlib
    df = spark.range(0, 500).withColumnRenamed("id", "k")
    got = [r.k for r in sample_exact_n(df, "k", 37, "7").collect()]
    want = sorted(range(500), key=lambda k: (hashlib.md5(f"{k}:7".encode()).hexdigest(), k))[:37]
    assert sorted(got) == sorted(want) and len(got) == 37
    arms = {r.k: r.g for r in df.select("k", assign_arm(F.col("k"), "arm").alias("g")).collect()}
    assert all(arms[k] == ("control" if hashlib.md5(f"{k}:arm".encode()).hexdigest()[0] < "8" else "variant")
               for k in range(500))
    member = df.where(hash_fraction_member(F.col("k"), "campaign", "60")).count()
    assert member == sum(hashlib.md5(f"{k}:campaign".encode()).hexdigest()[:2] < "60" for k in range(500))


def test_sample_matches_a_plain_top_n_for_every_n(spark):
    from tillsight.operators.sampling import salted_md5
    df = spark.range(0, 800).withColumnRenamed("id", "k")
    for n in (1, 300, 800, 900):
        got = sorted(r.k for r in sample_exact_n(df, "k", n, "s").collect())
        assert got == sorted(r.k for r in df.orderBy(salted_md5(F.col("k"), "s"), "k").limit(n).collect())


def test_product_codes_use_the_last_four_characters(spark):
    from tillsight.functions.text import product_code
    df = spark.createDataFrame([("electronics", "PROD0001"), ("toys", "12345"), ("toys", "7")], "c string, i string")
    assert [r[0] for r in df.select(product_code(F.col("c"), F.col("i"))).collect()] == ["ELEC-0001", "TOYS-2345", "TOYS-0007"]


def test_gap_filling_leaves_out_rows_without_a_month(spark):
    from tillsight.operators.gapfill import fill_month_gaps
    df = spark.sql("SELECT * FROM VALUES (DATE '2024-01-01', 1), (DATE '2024-03-01', 3), (CAST(NULL AS DATE), 9) AS t(month, v)")
    assert [r.v for r in fill_month_gaps(df, "month", ["v"]).orderBy("month").collect()] == [1, 0, 3]


def test_channel_matrix_keeps_unknown_channels(spark):
    from tillsight.plans.sales import region_channel_matrix

    class Tables:
        order_level = spark.sql("SELECT * FROM VALUES ('W', 'Email', 5.0), ('W', 'Fax', 9.0), ('W', NULL, 2.0) AS t(region, acquisition_channel, order_revenue)")
    row = region_channel_matrix(Tables, ["Email"]).first()
    assert (float(row["Email"]), float(row["other"])) == (5.0, 11.0)


def test_lines_carry_their_own_price_and_unknown_parts_stay(spark, scratch):
    from tillsight.sources.adapter import retail_from_driver
    spark.sql("SELECT 1L AS l_orderkey, 999L AS l_partkey, 4.0D AS l_quantity, 10.02D AS l_extendedprice").write.parquet(f"{scratch}/lineitem.parquet")
    row = retail_from_driver(spark, scratch).order_items.first()
    assert (row.quantity, float(row.unit_price), float(row.unit_cost)) == (4, 2.51, round(2.51 * (40 + 999 % 26) / 100, 2))

def test_exact_quantiles_with_heavy_ties_and_tiebreak(spark):
    vals = [5.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    got = exact_quantiles(df, "x", tiebreak=["id"]).collect()[0].edges
    assert got == list(np.quantile(np.array(vals), [0.25, 0.5, 0.75]))


def test_clip(spark):
    from tillsight.functions.numeric import clip
    df = spark.createDataFrame([(-1.0,), (0.5,), (3.0,), (None,)], "x double")
    assert [r.c for r in df.select(clip(F.col("x"), 0.02, 0.98).alias("c")).collect()] == [0.02, 0.5, 0.98, None]


def test_quality_operators_on_edge_cases(spark):
    from tillsight.operators.quality import Reference, foreign_key_orphans, primary_key_violations, table_profile
    empty = spark.createDataFrame([], "k string, v double")
    r = table_profile(empty, "e").collect()[0]
    assert (r.rows, r.null_cells, r.duplicate_rows) == (0, 0, 0)
    keys = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    pk = primary_key_violations(keys, "t", ["k"]).collect()[0]
    assert (pk.duplicated_keys, pk.null_keys) == (2, 2)  # 'a' and the NULL group repeat
    child = spark.createDataFrame([("a",), ("z",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    assert foreign_key_orphans({"c": child, "p": parent}, [Reference("c", "fk", "p", "pk")]).collect()[0].orphan_rows == 1


def test_shares_with_zero_total_are_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "k string, v double")
    assert [r.s for r in df.select(share_of_total(df, "v").alias("s")).collect()] == [None, None]


def test_fill_month_gaps_single_month_and_quantiles_of_one_value(spark):
    import datetime as dt
    df = spark.createDataFrame([("a", dt.date(2024, 5, 1), 3)], "g string, month date, v long")
    assert [tuple(r) for r in fill_month_gaps(df, "month", ["v"], ["g"]).collect()] == [("a", dt.date(2024, 5, 1), 3)]
    one = spark.createDataFrame([(1, 7.5)], "id long, x double")
    assert exact_quantiles(one, "x", tiebreak=["id"]).collect()[0].edges == [7.5, 7.5, 7.5]
