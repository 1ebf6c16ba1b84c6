"""Ranks: distributed ordinal rank and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.shared import written

def ordinal_rank(df: DataFrame, order_by: Sequence[Column | str], rank_col: str = "ordinal",
                 num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """1-based position of every row in the total order ``order_by``.

    A window without PARTITION BY would move every row into one task. Instead:
      1. range-partition on the sort keys (sampled bounds) and sort within each
         part. Equal keys land in the same part, so callers make the key unique
         (e.g. value plus row id): then parts stay evenly sized even when one
         value is shared by a third of the rows;
      2. number rows inside each part (partition id and local index come from the
         same task) and freeze that in a written table, so that the two
         readers below see the same numbering even after a lost executor;
      3. count rows per part (at most ``num_partitions`` rows), turn the counts into
         running offsets, materialise that small table once and broadcast it
         (bounded by the partition count);
      4. rank = offset of the part + local index + 1.
    Ties in ``order_by`` get distinct consecutive ranks (like ``row_number``).
    ``total_col`` adds the total number of rows (from the same small table), so
    callers need no separate count.
    """
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    part_id = F.spark_partition_id().cast("long")
    staged = written(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_rk_part", part_id)
        .withColumn("_rk_local", F.monotonically_increasing_id() - F.shiftleft(part_id, 33)),
        "ranks",
    )
    sizes = staged.groupBy("_rk_part").agg(F.count(F.lit(1)).alias("_rk_n"))
    # At most `parts` rows: a global window is fine here. The small table is
    # materialised once, so readers of the result do not each rescan the
    # staged rows to recount them.
    offsets = written(sizes.select(
        "_rk_part",
        F.coalesce(
            F.sum("_rk_n").over(Window.orderBy("_rk_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_rk_offset"),
        F.sum("_rk_n").over(Window.partitionBy()).alias("_rk_total"),
    ), "rank-offsets")
    ranked = (
        staged.join(F.broadcast(offsets), "_rk_part")
        .withColumn(rank_col, F.col("_rk_offset") + F.col("_rk_local") + F.lit(1))
    )
    if total_col:
        ranked = ranked.withColumnRenamed("_rk_total", total_col)
    return ranked.drop("_rk_part", "_rk_local", "_rk_offset", "_rk_total")


def top_k_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
                    k: int, rank_col: str = "rank", method: str = "rank") -> DataFrame:
    """Rows whose rank within their group is <= k.

    ``rank`` keeps ties (may return more than k rows per group), ``row_number``
    does not. Filtering on the rank lets Spark insert a partial WindowGroupLimit
    before the shuffle, so each task forwards only its own top k per group:
    a hot group does not move all its rows into one task.
    """
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, fn().over(w)).where(F.col(rank_col) <= k)
