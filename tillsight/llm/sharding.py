"""Sharding by global byte-size prefix sums.

Rows are put into one global order (the text's crc32, then id, then size, so that
equal texts lie side by side) by a range partitioning. Per-partition byte and row totals, one row
for each partition, give every partition its offset; a running sum inside the
partition does the rest. A row belongs to the shard in whose equal target its
first byte falls: ``shard = start * shards div total``. Shards are therefore
contiguous in that order, and their sizes differ by less than two rows' bytes.

All of it is DataFrame functions. The range keys hold the id, so a text that
repeats very often is spread over many partitions.

Defined results: a null text has no bytes (size 1, as an empty text); rows with null or repeated
ids are rows of their own; rows that agree in all of id, size and crc32 are
interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in the shard, from 0) for every row of ``docs``."""
    base = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    order = ["text_crc32", "doc_id", "size"]
    # written, so that the partition of a row is a fact and not the outcome of one run
    ranged = written(base.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # one row for each partition
    offsets = totals.selectExpr("part", "sum(bytes) OVER (ORDER BY part) - bytes AS byte_offset", "sum(rows) OVER (ORDER BY part) - rows AS row_offset",
                                "sum(bytes) OVER () AS total")
    run = "OVER (PARTITION BY part ORDER BY text_crc32, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    placed = (ranged.withColumn("start", F.expr(f"sum(size) {run} - size")).withColumn("row", F.expr(f"count(1) {run} - 1"))
              .join(F.broadcast(offsets), "part")
              .selectExpr("doc_id", "size", "text_crc32", f"cast((start + byte_offset) * cast({shards} AS decimal(10, 0)) div total AS int) AS shard", "row + row_offset AS row"))
    placed = written(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))
