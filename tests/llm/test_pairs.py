"""Near duplicates, components, top-k and the pipeline against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from tillsight.llm import common, near_dup, topk
from tillsight.llm import components as components_module
from tillsight.llm.components import connected_components


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k, 0) + 1)) if w else frozenset()


def brute(texts, k, percent):
    sets = {}
    for i, t in texts:
        if i is not None:
            sets[i] = shingle_set(t, k)
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, components(sets, links)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(corpus, texts, k, percent):
    sets, parent = brute(texts, k, percent)
    want = Counter((i, len(shingle_set(t, k)), parent.get(i), i is None or parent[i] == i) for i, t in texts)
    assert Counter(map(tuple, near_dup.near_duplicates(corpus, k, percent).collect())) == want
    assert sum(1 for i, c in parent.items() if i != c) >= 5


def test_a_large_group_of_drifting_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(250):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        texts.append((i, " ".join(w)))
    _, parent = brute(texts, 3, 85)
    got = near_dup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == parent
    assert len(set(parent.values())) > 10


def test_near_duplicates_of_no_rows(corpus):
    assert near_dup.near_duplicates(corpus.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = components({x for e in links for x in e}, links)
    assert got == {i: c for i, c in want.items() if i != 200}


def test_near_duplicates_broadcast_the_id_filter_alone(spark, corpus, monkeypatch):
    made, write = [], common.written

    def spy(df, name, **options):
        made.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, **options)

    monkeypatch.setattr(near_dup, "written", spy)
    monkeypatch.setattr(components_module, "written", spy)
    result = near_dup.near_duplicates(corpus, 3, 85)
    made.append(result._jdf.queryExecution().executedPlan().toString())
    joins = [line for plan in made for line in plan.splitlines() if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]
    assert len(made) > 10 and "SortMergeJoin" in "".join(made) and all("__cell" in line for line in joins)


def best_products(rows, k, every=20):
    """Every usable row against all others of its length, ties to smaller ids."""
    good = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for a, (q, x) in enumerate(good):
        if q % every == 0:
            best = sorted((-int(x @ y), i) for b, (i, y) in enumerate(good) if a != b and len(x) == len(y))[:k]
            want.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return want


def found_products(spark, rows, k=20):
    return Counter(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 20 = 0", k=k).collect()))


def test_top_k_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 700)]  # one very common vector
    rows += [(700, None), (720, [float("nan")] * 8), (740, [float("inf")] + [0.0] * 7), (760, [None] + [0.0] * 7), (780, []), (800, [1.0] * 3), (None, [0.1] * 8), (820, [0.0] * 8)]
    rows += [(i, [float(x) for x in rng.normal(0, 0.3, 3)]) for i in range(900, 960)] + [(980, [0.1, 0.2])]  # other lengths
    rows += [(7, [0.9] * 8), (7, [0.9] * 8), (40, [0.7] * 8), (40, [0.5] * 8), (40, [0.5] * 8)]  # repeated ids and rows
    assert found_products(spark, rows) == best_products(rows, 20)
    monkeypatch.setattr(topk, "BLOCK", 30)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    assert found_products(spark, rows, 5) == best_products(rows, 5)


def test_top_k_of_few_rows_and_repeated_ids(spark):
    assert sum(found_products(spark, [(0, [1.0]), (1, [2.0]), (2, [3.0])]).values()) == 2
    got = found_products(spark, [(20, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (2, [0.1, 0.0])])
    assert got == {(20, 1, 1, 3648): 1, (20, 2, 1, 2048): 1, (20, 3, 2, 384): 1}
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), "true").count() == 0


def test_ties_at_the_floor_are_not_all_handed_on(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    rows = [(i, [0.5] * 4) for i in range(2000)] + [(2000 + 20 * i, [0.25 + i / 64] * 4) for i in range(10)]
    seen, compare = [], topk._compare
    monkeypatch.setattr(topk, "_compare", lambda pairs, k: seen.append(compare(pairs, k)) or seen[-1])
    assert found_products(spark, rows, 5) == best_products(rows, 5)
    queries = sum(i % 20 == 0 for i, _ in rows)
    assert seen[-1].count() <= 5 * queries * 6  # 40 blocks hold ties for every query


def test_pipeline_stages_keep_columns_and_take_effect(spark, corpus, scratch):
    import corpus_pipeline
    docs = corpus.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    docs.select("doc_id").selectExpr("doc_id", "1 AS quality", "0 AS toxic").write.parquet(f"{scratch}/labels.parquet")
    text = docs.where("doc_id = 10").first().text
    spark.createDataFrame([(1, " ".join(text.split()[:30]))], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs.write.parquet(f"{scratch}/documents.parquet")
    kept = corpus_pipeline.near_dedup(spark, docs, scratch)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    _, parent = brute(rows, 5, 80)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(i for i, c in parent.items() if i == c)
    clean = corpus_pipeline.decontamination(spark, docs, scratch)
    assert clean.columns == docs.columns and {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in clean.select("doc_id").collect()} == {10}
    assert corpus_pipeline.near_dedup(spark, corpus, scratch).where("doc_id = 5").count() == 1
    assert corpus_pipeline.run(spark, scratch).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "packing"]


def repeated_ids(rng):
    make = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    far, hub, near = make(60), make(60), make(60)
    # id 5 has two unlike texts, of which one is a near copy of id 3; id 7 a null text, and a text that many copy nearly
    rows = [(3, near), (5, near + " more"), (5, far), (5, far), (7, None), (7, hub), (9, far + " more"), (11, make(60))]
    return rows + [(100 + i, " ".join(["edit", *hub.split()[1:], f"x{i}"])) for i in range(12)] + [(50, make(40)) for _ in range(30)]


def test_near_duplicates_of_ids_with_several_texts(spark):
    rows = repeated_ids(random.Random(4))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    want = Counter((i, len(shingle_set(t, 3)), {9: 5}.get(i, 7 if i >= 100 else i), i < 100 and i != 9) for i, t in rows if i != 5)
    want += Counter({(5, 59, 3, False): 1, (5, 58, 5, True): 2})
    assert Counter(map(tuple, got)) == want


def test_pipeline_keeps_different_texts_of_one_id(spark, scratch):
    import corpus_pipeline
    rows = repeated_ids(random.Random(4))
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), scratch)
    far = rows[2]
    want = Counter([rows[0], far, rows[4], rows[5], rows[7], *rows[-30:]])
    assert Counter(map(tuple, kept.collect())) == want  # one far, both rows of id 7, all 30 texts of id 50


def test_near_duplicates_of_text_ids(spark, scratch):
    """Ids of any type name documents; the smallest is that of their order."""
    import corpus_pipeline
    rows = [(f"d{i}-{'x' * (i % 3)}", t) for i, t in repeated_ids(random.Random(4))]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    numbers = {d: k for k, d in enumerate(sorted({i for i, _ in rows}))}
    numbered = spark.createDataFrame([(numbers[i], t) for i, t in rows], "doc_id long, text string")
    got = Counter((numbers[r.doc_id], r.n_shingles, numbers[r.component_id], r.kept) for r in near_dup.near_duplicates(docs, 3, 85).collect())
    assert got == Counter(map(tuple, near_dup.near_duplicates(numbered, 3, 85).collect()))
    kept = Counter((numbers[r.doc_id], r.text) for r in corpus_pipeline.near_dedup(spark, docs, scratch).collect())
    assert kept == Counter(map(tuple, corpus_pipeline.near_dedup(spark, numbered, scratch).collect()))


def test_the_id_filter_keeps_its_ids_without_python(spark):
    ids = spark.range(0, 100_000, 97).withColumnRenamed("id", "doc_id")
    rows = spark.range(100_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    kept = common.filtered(rows, "doc_id", common.id_filter(ids, "doc_id"))
    assert kept.columns == rows.columns and kept.join(ids, "doc_id").count() == ids.count()
    assert ids.count() <= kept.count() < 1.05 * ids.count() + 100
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    assert common.filtered(rows, "doc_id", common.id_filter(ids.limit(0), "doc_id")).count() == 0
