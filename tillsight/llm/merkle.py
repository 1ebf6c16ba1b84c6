"""Merkle manifest of a table: stored tiers, proofs that regenerate the rest.

Every row is a leaf, a sha256 over its fields. The rows of one tree (a source)
ascend by their order column; every ``RUN`` consecutive nodes become the digest
of their joined hex texts until one is left, the subroot. The subroots,
ordered by tree (null first, bytewise), give the root in the same way.

Only every second level is persisted: a stored block holds the ``RUN ** 2`` nodes
of an aligned subtree, its two upper levels are recomputed from them whenever they
are needed. Proofs are extracted from the root down, tier by tier: each block
regenerates its missing level, adds its siblings to the proof it got from above and
drops the level again. Blocks of one tree lie apart, so a tree that holds a third of all
rows is as spread as any other; positions come from range partitions and their
counts. Leaves are hashed once, and only digests and ids are shuffled.

Defined results: a null field counts as ``-``, so nulls and empty texts differ; a null tree is a
tree of its own, a null order value comes first; rows that share tree and order value
stand in order of their leaves, rows that repeat in every field are leaves of their own; an empty
table gives no rows. Other columns of the table are never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.ranking import ordinal_rank

from .common import BROADCAST_ROWS, written

#: Nodes that share a parent, and those of a stored block (two levels).
RUN = 16
WIDE = RUN * RUN
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "array<struct<left: string, right: string>>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """sha256 of the values, each as byte count, ``:`` and text, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


@dataclass(frozen=True)
class Manifest:
    """Stored blocks of the trees and of the tree of subroots, lowest tier first, and the one-row top."""

    tiers: list[DataFrame]
    top_tiers: list[DataFrame]
    top: DataFrame


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "source", order: str = "doc_id", shown: Column | None = None) -> Manifest:
    """Build and store the manifest.

    ``shown`` is the leaf that a verifier will be shown instead of the stored one (null: the same).
    """
    leaves = written(rows.select(F.col(tree).alias("tree"), F.col(order).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
                                 (F.lit(None).cast("string") if shown is None else shown).alias("shown"), F.monotonically_increasing_id().alias("row")), "leaves")
    ranked = ordinal_rank(leaves, ["tree", "id", "digest", "row"], "at")
    trees = written(ranked.groupBy("tree").agg(F.min("at").alias("first"), F.count("*").alias("n")), "trees").withColumnRenamed("tree", "of")
    n_trees, most = trees.agg(F.count("*"), F.max("n")).first()
    placed = ranked.join(F.broadcast(trees) if n_trees <= BROADCAST_ROWS else trees, F.col("tree").eqNullSafe(F.col("of")))
    nodes = placed.select("tree", (F.col("at") - F.col("first")).alias("pos"), "digest", "n", "id", "shown")
    tiers, subroots = _raised(nodes, most or 0, ["id", "shown"])
    named = ordinal_rank(subroots.select(F.col("tree").alias("name"), "digest"), ["name"], "at", total_col="n")
    nodes = named.select(F.lit(0).alias("tree"), (F.col("at") - 1).alias("pos"), "digest", "n", "name")
    top_tiers, top = _raised(nodes, n_trees, ["name"])
    return Manifest(tiers, top_tiers, top)


def _raised(nodes: DataFrame, most: int, carried: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The stored tiers over ``nodes`` (tree, pos, digest, n: nodes of the tree), and each tree's last node."""
    tiers = []
    while True:
        blocks = written(nodes.groupBy("tree", F.expr(f"pos div {WIDE}").alias("block"))
                         .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("nodes"), F.max("n").alias("n")), f"tier{len(tiers)}")
        tiers.append(blocks)
        upper = _upper_level()
        digest = (F.when(F.col("n") == 1, F.col("nodes.digest")[0]).when(F.col("n") <= RUN, upper[0])
                  .otherwise(F.sha2(F.array_join(upper, ""), 256)))
        nodes = blocks.select("tree", F.col("block").alias("pos"), digest.alias("digest"), F.expr(f"(n + {WIDE - 1}) div {WIDE}").alias("n"))
        carried, most = (), (most + WIDE - 1) // WIDE
        if most <= 1:
            return tiers, nodes


def _upper_level() -> Column:
    """The level above a stored block's nodes, regenerated."""
    runs = F.sequence(F.lit(0), F.expr(f"(size(nodes) - 1) div {RUN}"))
    return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(F.col("nodes.digest"), r * RUN + 1, RUN), ""), 256))


def _opened(blocks: DataFrame, above: DataFrame, carried: Sequence[str], handed: Sequence[str]) -> DataFrame:
    """The nodes of ``blocks`` with their proofs; ``above``: (tree, pos, proof, ``handed``) of the blocks' own nodes."""
    above = above.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("proof").alias("_proof"), *handed)
    both = blocks.join(above, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_pos")))
    both = both.withColumn("_low", F.col("nodes.digest")).withColumn("_high", _upper_level())

    def around(level: str, start: Column, at: Column) -> Column:
        """The run's other nodes: those left of place ``at`` and those right of it."""
        return F.struct(F.array_join(F.slice(level, start + 1, at - start), "").alias("left"),
                        F.array_join(F.slice(level, at + 2, start + RUN - 1 - at), "").alias("right"))

    def node(x: Column, i: Column) -> Column:
        run = F.floor(i / RUN).cast("int")
        low, high = around("_low", run * RUN, i), around("_high", F.lit(0), run)
        own = F.when(F.col("n") == 1, F.array().cast(_PROOF)).when(F.col("n") <= RUN, F.array(low)).otherwise(F.array(low, high))
        return F.struct(x["pos"].alias("pos"), x["digest"].alias("digest"), *[x[c].alias(c) for c in carried], F.concat(own, F.col("_proof")).alias("proof"))

    return both.select("tree", F.explode(F.transform("nodes", node)).alias("x"), *handed).select("tree", "x.*", *handed)


def proofs(m: Manifest) -> DataFrame:
    """tree, pos, digest, id, shown, proof, subroot, root: a row per leaf.

    proof: per level, from the leaf up, the joined digests of the siblings on either side.
    """
    above = m.top.select("tree", "pos", F.array().cast(_PROOF).alias("proof"), F.col("digest").alias("root"))
    for tier, blocks in reversed(list(enumerate(m.top_tiers))):
        above = _opened(blocks, above, ["name"] if tier == 0 else [], ["root"])
    above = above.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "proof", F.col("digest").alias("subroot"), "root")
    for tier, blocks in reversed(list(enumerate(m.tiers))):
        above = _opened(blocks, above, ["id", "shown"] if tier == 0 else [], ["subroot", "root"])
    return above


def folded(leaf: Column, proof: str = "proof") -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def siblings(proof: str = "proof") -> Column:
    """All siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")
