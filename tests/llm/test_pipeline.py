"""Each pipeline stage, and the whole, against a plain version on awkward rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillsight.llm import quality_fm
from tillsight.llm.tokenizing import byte_level

CLASHING = ["__md5", "__id", "__score", "__md5_", "doc_id_", "w", "tok", "i", "wid", "a", "b", "u", "v", "component_id"]


@pytest.fixture()
def folder(spark, corpus, scratch):
    """The corpus with clashing columns; labels that punish long texts; a benchmark that holds a passage of document 10."""
    docs = corpus.select("*", *[F.lit(1).alias(c) for c in CLASHING])
    docs.write.parquet(f"{scratch}/documents.parquet")
    corpus.where("doc_id IS NOT NULL").selectExpr("doc_id", "cast(length(coalesce(text, '')) < 900 AS int) AS quality", "0 AS toxic").distinct().write.parquet(f"{scratch}/labels.parquet")
    text = corpus.where("doc_id = 10").first().text
    spark.createDataFrame([(1, " ".join(text.split()[:30]))], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_quality_keeps_what_the_model_accepts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, folder)
    assert kept.columns == docs.columns
    model = quality_fm.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), learn=~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))

    def probability(row):  # all pairs of features, one by one
        idx, val = quality_fm.features(row.text, row.n_chars)
        raw = model.bias + float(model.linear[idx] @ val)
        gram = model.factors[idx] @ model.factors[idx].T * np.outer(val, val)
        return 1 / (1 + math.exp(-(raw + float(np.triu(gram, 1).sum()))))

    rows = docs.collect()
    assert rows_of(kept) == Counter(tuple(r) for r in rows if probability(r) >= corpus_pipeline.QUALITY_FLOOR)
    assert 0 < kept.count() < len(rows)


def test_clashing_columns_pass_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.decontamination):
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        assert not rows_of(kept) - rows_of(docs)
    assert rows_of(docs) - rows_of(corpus_pipeline.decontamination(spark, docs, folder)) == Counter(tuple(r) for r in docs.where("doc_id = 10").collect())
    assert corpus_pipeline.pack(spark, docs, folder).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_empty_tables_pass_every_stage(spark, folder, scratch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_the_run_packs_exactly_what_the_stages_keep(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    pieces, encode = corpus_pipeline.run(spark, folder).collect(), byte_level("byte_bpe_50k.json").ids
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id, (encode(r.text) if r.text else b"") + (1).to_bytes(4, "little")] += 1
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
        sequences[r.sequence_id].append((r.offset, r.length))
    got = Counter()
    for (doc_id, n), parts in by_doc.items():
        text = b"".join(ids for _, ids in sorted(parts))
        copies = len(text) // (4 * n)  # rows without id may share a key
        assert len(text) == copies * 4 * n
        if copies == 1:
            got[doc_id, text] += 1
    assert all(got[k] == n for k, n in want.items() if n == 1 and sum(1 for x in want if x[0] == k[0]) == 1) and got
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
