"""Corpus pipeline: quality filter, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. The first three return rows of ``docs`` with their columns unchanged; the
last returns the packed pieces. ``run`` writes each stage's result into the
shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import decontaminate, near_dup, packing, quality_fm
from tillsight.llm.common import BROADCAST_ROWS, bounded_batches, id_crc32, id_type, table, without, written

#: Documents whose probability of quality 1 is below this go.
QUALITY_FLOOR = 0.5


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects.

    Null and empty texts are scored like any other; rows that repeat an id are scored by their own text; a row without
    id has no label but is scored. An empty table gives an empty table.
    """
    held_out = F.coalesce(id_crc32(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    score = fresh(docs, "__score")
    return docs.withColumn(score, quality_fm.score_column(docs, model)).where(F.col(score) >= QUALITY_FLOOR).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group (5-word shingles, similarity 0.8).

    Rows that repeat an id and its text count as one document, other texts under that id
    are documents of their own; rows without an id stay. Empty and null texts are linked with nothing. Of rows equal in
    id and text one stays, with its other columns.
    """
    bounded_batches(spark)
    doc_id, md5 = fresh(docs, "__id"), fresh(docs, "__md5")
    found = written(near_dup.grouped(docs, words=5, percent=80), "near-dedup").where("doc_id IS NOT NULL")
    key = [F.col("doc_id").alias(doc_id), F.col("text_md5").alias(md5)]
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("text_md5") == F.col("component_md5"))
    gone = written(found.where(~stays).select(*key).distinct(), "near-dedup-gone")
    repeated = written(found.where(stays).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "near-dedup-repeated")
    same = (F.col("doc_id").cast(id_type(docs)) == F.col(doc_id)) & (near_dup.text_key(F.col("text")) == F.col(md5))
    rest = without(docs, gone, same)
    many = repeated.count()
    if not many:
        return rest
    again = rest.join(F.broadcast(repeated) if many <= BROADCAST_ROWS else repeated, same, "left_semi")
    again = again.withColumn(md5, near_dup.text_key(F.col("text"))).dropDuplicates(["doc_id", md5])
    return without(rest, repeated, same).unionByName(again.drop(md5)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a 10-word window of a benchmark item occurs.

    Null and empty texts hold none and stay. Rows go by id and text, so another text under the same id stays,
    and so do all rows if the benchmark is empty.
    """
    doc_id, md5 = fresh(docs, "__id"), fresh(docs, "__md5")
    hits, _, _ = decontaminate.document_hits(docs, table(spark, sf_dir, "benchmark"), window=10)
    bad = written(hits.select(F.col("doc_id").alias(doc_id), F.col("text_md5").alias(md5)).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.md5(F.coalesce("text", F.lit("")).cast("binary")) == F.col(md5))
    return without(docs, bad, same)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens; a null or empty text is its end id alone."""
    bounded_batches(spark)
    return packing.pack(docs)


STAGES = [("quality_classifier", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

#: The classifier, the components and the packing are not SQL; tests/llm hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
