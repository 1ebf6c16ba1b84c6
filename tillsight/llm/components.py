"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star_forest(edges: DataFrame) -> bool:
    """Whether no id is both a child and a parent, and each child has one parent (edges u to v, distinct)."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child + parent > 1 AND child > 0").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id that occurs in ``edges`` (columns a, b: long).

    component is the smallest id that is reachable. Each round hangs every
    neighbour of a node on the smallest id nearby (large star on both sides,
    then small star); the rounds end when the edges are a star forest, after
    about log(ids) rounds. Minima are pre-aggregated before every shuffle, and
    each round's edges are cut from the lineage by files in the shared folder. The joins are
    merged, not broadcast, so no round's edges pass through the driver.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        # large star: larger neighbours of u go to the smallest of u's neighbourhood
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u, and u, go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = written(small, "edges")
        if _star_forest(now):
            break
    else:
        raise RuntimeError(f"no star forest after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select("id", F.col("id").alias("component")))
