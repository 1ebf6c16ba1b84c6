"""Registered queries of this package: opN_<name> over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, kmeans_tree, licenses, lm_scoring, merkle, near_dup, packing, prefix_trie, quality_fm, sharding, token_counts, topk, url_graph
from .common import ascii_lower, id_crc32, table
from .oracles import OP11_SQL, OP13_SQL


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(id_crc32(F.col("doc_id")) % 7 == 2, F.lit(False))
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), held_out, tokenizer="byte_bpe_50k.json")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer="piece_bpe_32k.model", limit=4096)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Fixed values: (verdict, host, path) of the rules.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_crc32(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = quality_fm.train(docs, labels, learn=~held_out)
    return (docs.select("doc_id", held_out.alias("held_out"), quality_fm.score_column(docs, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer="byte_bpe_50k.json", end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    families = F.array_sort(F.array_distinct(F.col("licences.family")))
    versions = F.array_sort(F.array_distinct(F.transform("licences", lambda x: F.concat_ws(" ", x["family"], x["version"]))))
    return found.select("doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licences"), F.concat_ws(",", families).alias("families"),
                        F.concat_ws(",", versions).alias("versions"), F.array_max("licences.probability").alias("probability"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    nodes = prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations"), base=conv - conv % 20, shared=id_crc32(conv) % 4))
    return nodes.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def op12_ann_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kmeans_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = merkle.leaf_digest([ascii_lower(F.col(f)) if f == "text" else F.col(f) for f in merkle.FIELDS])
    shown = F.when(id_crc32(F.col("doc_id")) % 5 == 0, tampered)
    rows = merkle.proofs(merkle.manifest(table(spark, sf_dir, "documents"), shown=shown))
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("shown", "digest")))
    return rows.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2(merkle.siblings(), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_benchmark_decontamination, op2_exact_top_k, op3_lm_scoring, op4_token_counts, op5_sharding, op6_url_filters, op7_quality_classifier, op8_packing, op9_minhash_near_dedup, op10_license_scan, op11_conversation_trie, op12_ann_kmeans_tree, op13_merkle_manifest)}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{decontaminate.WORD}') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{decontaminate.WORD}') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), bw AS (
  SELECT item_id, w, least(10, len(w)) AS k, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS s FROM bw
), dw AS (
  SELECT d.rid, ks.k, d.w, unnest(range(0, len(d.w) - ks.k + 1)) AS i
  FROM d, (SELECT DISTINCT k FROM win) ks WHERE len(d.w) >= ks.k
), pos AS (
  SELECT rid, k, i, array_to_string(w[i + 1:i + k], ' ') AS s FROM dw
), hit AS (
  SELECT pos.rid, pos.i, pos.k, win.item_id FROM pos JOIN win ON pos.k = win.k AND pos.s = win.s
), spot AS (
  SELECT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, i, k FROM hit)
), cov AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM spot GROUP BY rid
), its AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(cov.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(cov.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov ON d.rid = cov.rid LEFT JOIN its ON d.rid = its.rid
"""

OP2_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY s.r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLE: dict[str, str] = {"op2_exact_top_k": OP2_SQL, "op1_benchmark_decontamination": OP1_SQL, "op11_conversation_trie": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
