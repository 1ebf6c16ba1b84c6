"""The k-means tree against brute force: equal when every leaf is visited, recall otherwise."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import kmeans_tree
from tillsight.llm.queries import op12_ann_kmeans_tree

COLUMNS = "vec_id long, embedding array<double>"
ALL = 1 << 30


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = (np.ldexp(np.array(x), -int(np.frexp(np.abs(x).max())[1])) for x in (a, b))
    return (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))


def brute(rows, every, k):
    rows = [r for r in rows if r[0] is not None and usable(r[1])]
    out = []
    for i, (q, x) in enumerate(rows):
        if q % every == 0:
            near = sorted((-cosine(y, x), c) for j, (c, y) in enumerate(rows) if j != i and len(y) == len(x))[:k]
            out += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(near)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-12)


def awkward(rng):
    x = rng.standard_normal((400, 8)).round(2)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, x[7].tolist()) for i in range(300)]  # one vector that many rows share
    rows += [(2000 + i, [1.0, float(i)]) for i in range(12)] + [(3000, [1.0, 2.0, 3.0])]  # other lengths, one alone
    rows += [(20, x[3].tolist()), (20, x[3].tolist()), (41, x[5].tolist())]  # repeated ids and rows
    rows += [(5000, None), (5001, []), (5002, [0.0] * 8), (5003, [1.0, None] * 4), (5004, [float("nan")] * 8), (5005, [float("inf")] * 8), (None, x[0].tolist())]
    rows += [(6000, (x[9] * 1e200).tolist()), (6020, (x[9] * 1e-200).tolist())]
    return rows


def test_all_leaves_give_the_exact_result(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF", 20)
    monkeypatch.setattr(kmeans_tree, "BLOCK_VALUES", 400)
    monkeypatch.setattr(kmeans_tree, "QUERY_BLOCK", 7)
    rows = awkward(np.random.default_rng(1))
    df = spark.createDataFrame(rows, COLUMNS).select("*", *[F.lit("x").alias(c) for c in ("row", "v", "width", "leaf", "query", "score", "rank")])
    same(found(kmeans_tree.nearest(df, F.col("vec_id") % 20 == 0, k=5, visits=ALL)), brute(rows, 20, 5))


def test_visits_go_on_until_there_are_enough_candidates(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF", 1)
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 4)))]
    got = found(kmeans_tree.nearest(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") % 50 == 0, k=60, visits=1))
    assert len(got) == 4 * 60


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    rows = [(50 * i, [1.0, float(i)]) for i in range(n)]
    got = found(kmeans_tree.nearest(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") % 50 == 0))
    same(got, brute(rows, 50, 5))


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    t = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    rows = [(int(i), np.asarray(v, np.float64)) for i, v in zip(t["vec_id"], t["embedding"], strict=True)]
    want = brute(rows, 50, 5)
    got = found(op12_ann_kmeans_tree(spark, folder))
    assert len(got) == len(want)
    assert len({(q, c) for q, _, c, _ in want} & {(q, c) for q, _, c, _ in got}) >= 0.9 * len(want)
    vectors = dict(rows)
    assert all(abs(s - cosine(vectors[q], vectors[c])) < 1e-12 for q, _, c, s in got)


def test_a_clustered_table_needs_few_visits(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF", 50)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16))
    rows = [(i, (centres[i % 60] + 0.1 * rng.standard_normal(16)).tolist()) for i in range(1800)]
    df = spark.createDataFrame(rows, COLUMNS)
    trees, index = kmeans_tree.build(kmeans_tree.usable(df, F.col("vec_id") % 50 == 0))
    kmeans_tree.calibrate(trees, index, 5, 0.96)
    assert len(trees[16].rows) >= 30 and trees[16].visits <= 4
    assert trees[16].rows.sum() == 1800  # every row is indexed
