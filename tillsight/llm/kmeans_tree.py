"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``SAMPLE`` rows, ``SAMPLE_VALUES`` components): each node
splits its unit vectors into ``BRANCH`` clusters until a leaf stands for about ``LEAF`` rows of the table
or too few sampled rows are left. Then every row of the table is keyed by its leaf, and the rows of a leaf
are stored in blocks, as many as it takes: a vector that a third of all rows share fills many blocks, which
are many tasks.

A query walks the tree with a priority queue of nodes, nearest centre first, and visits leaves
until their calibrated number is reached and they hold enough candidates. Calibration: for
``PROBES`` rows the exact neighbours among all rows are found by one pass over the table; the visit at which the walk
reaches each neighbour's leaf gives the recall of any number of visits, and the least number
with ``target`` recall is taken. Where the data have no structure this becomes the whole
table, which is then what the recall costs.

Queries travel to the leaves they visit in blocks; a pair of blocks is one matrix product. Those that can be among
the best are scored again one by one in double precision, always summed in the same order, so
equal vectors have equal scores.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components and rows without id take no
part; vectors are compared with those of their own length; a query's own row is no candidate, other
rows that repeat its id or its vector are; equal scores go to the smaller id; fewer candidates than k give them
all. Other columns are never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bounds of the sample that trees are fitted on, over all lengths of vectors.
SAMPLE, SAMPLE_VALUES = 32_768, 1 << 22
#: Clusters of a node, rows that a leaf should stand for, sampled rows below which a node is not split, rounds of Lloyd's algorithm.
BRANCH, LEAF, FEWEST, ROUNDS = 16, 256, 32, 8
#: Rows whose exact neighbours calibrate the visits of a length.
PROBES = 512
#: Components of a block of rows (8 bytes each at most) and queries of a block.
BLOCK_VALUES, QUERY_BLOCK = 1 << 17, 256
_FOUND = "q_row long, query_id long, row long, vec_id long, score double"


def usable(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, v, width, query): the vectors that take part, each with a number of its own."""
    found = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    found = found.where("vec_id IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)")
    return written(found.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.size("v").alias("width"), "query"), "vectors")


@dataclass
class Tree:
    """Nodes in breadth-first order: ``centres``, first and last child, number of the leaf (-1: inner), rows of each leaf, visits."""

    centres: np.ndarray
    first: np.ndarray
    last: np.ndarray
    leaf: np.ndarray
    rows: np.ndarray
    visits: int = 1

    def leaf_of(self, unit: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at every node the nearest child."""
        at = np.zeros(len(unit), np.int64)
        while True:
            open_rows = np.flatnonzero(self.leaf[at] < 0)
            if not len(open_rows):
                return self.leaf[at]
            for node in np.unique(at[open_rows]):
                mine = open_rows[at[open_rows] == node]
                a, b = self.first[node], self.last[node]
                at[mine] = a + (unit[mine] @ self.centres[a:b].T).argmax(1)

    def walk(self, unit: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
            else:
                a, b = self.first[node], self.last[node]
                for i, near in enumerate((self.centres[a:b] @ unit).tolist()):
                    heapq.heappush(queue, (-near, int(a) + i))

    def visited(self, unit: np.ndarray, least: int) -> list[int]:
        """The calibrated number of leaves, and more until they hold ``least`` rows."""
        out, rows = [], 0
        for leaf in self.walk(unit):
            out.append(leaf)
            rows += int(self.rows[leaf])
            if len(out) >= self.visits and rows >= least:
                break
        return out


def _scaled(v) -> np.ndarray:
    """Vectors as doubles, each times a power of two, so that no square overflows: cosines stay as they are."""
    x = np.stack([np.asarray(a, np.float64) for a in v])
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _clusters(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres and nearest centre of spherical k-means; clusters that run empty go."""
    centres = x[rng.choice(len(x), min(BRANCH, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(1))
        centres = sums[norm > 1e-12] / norm[norm > 1e-12][:, None]
    near = (x @ centres.T).argmax(1)
    kept, near = np.unique(near, return_inverse=True)
    return centres[kept], near


def fit(sample: np.ndarray, share: float) -> Tree:
    """A tree over distinct unit vectors; ``share``: rows of the table that a sampled one stands for."""
    rng = np.random.default_rng(7)
    centres, first, last, leaf = [np.zeros(sample.shape[1])], [0], [0], [-1]
    todo, leaves = [(0, np.arange(len(sample)))], 0
    while todo:  # breadth first, so that children of a node are neighbours
        below = []
        for node, rows in todo:
            found = _clusters(sample[rows], rng) if len(rows) >= FEWEST and len(rows) * share > LEAF else (np.zeros((0, 0)), None)
            if len(found[0]) < 2:
                leaf[node], leaves = leaves, leaves + 1
                continue
            first[node], last[node] = len(centres), len(centres) + len(found[0])
            for i, c in enumerate(found[0]):
                below.append((len(centres), rows[found[1] == i]))
                centres.append(c)
                first.append(0), last.append(0), leaf.append(-1)
        todo = below
    return Tree(np.stack(centres), np.array(first), np.array(last), np.array(leaf), np.zeros(leaves, np.int64))


def _chosen(rows: DataFrame, salt: str, most: int, values: int) -> pd.DataFrame:
    """At most ``most`` rows and ``values`` components over all lengths: of each length those of smallest hash."""
    widths = rows.select("width").distinct().count()
    w = Window.partitionBy("width").orderBy(F.xxhash64(F.lit(salt), "vec_id", "v"), "row")
    kept = rows.withColumn("place", F.row_number().over(w)).where((F.col("place") <= max(1, most // max(widths, 1)))
                                                                  & ((F.col("place") == 1) | (F.col("place") * F.col("width") <= max(1, values // max(widths, 1)))))
    return kept.select("row", "v", "width").toPandas()


def build(rows: DataFrame) -> tuple[dict[int, Tree], DataFrame]:
    """Trees by length, and every row with its leaf (written)."""
    totals = {r.width: r["count"] for r in rows.groupBy("width").count().collect()}  # a row per length
    trees = {}
    for width, part in _chosen(rows, "fit", SAMPLE, SAMPLE_VALUES).groupby("width"):
        x = _unit(_scaled(part["v"]))
        trees[int(width)] = fit(np.unique(x, axis=0), totals[width] / len(x))
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for width, part in b.groupby("width"):
                yield part.assign(leaf=shared.value[int(width)].leaf_of(_unit(_scaled(part["v"]))).astype(np.int32))

    index = written(rows.mapInPandas(keyed, f"row long, vec_id long, v {rows.schema['v'].dataType.simpleString()}, width int, query boolean, leaf int"), "keyed")
    for r in index.groupBy("width", "leaf").count().collect():  # leaves are bounded by the sample
        trees[r.width].rows[r.leaf] = r["count"]
    return trees, index


def _best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((rows, ids, -score))[:k]


class _Against:
    """Compares some queries with rows; keeps no more than the k best of each."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, k: int):
        self.x, self.rows, self.k = x, rows, k
        self.unit, self.norm = _unit(x), np.sqrt((x * x).sum(1))

    def best(self, x: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, places, scores): the k best of each query among ``x``, without its own row."""
        unit, norm = _unit(x), np.sqrt((x * x).sum(1))
        near = self.unit @ unit.T
        for i, score in enumerate(near):
            score[rows == self.rows[i]] = -np.inf
            cut = -3.0 if len(score) <= self.k else np.partition(score, len(score) - self.k)[len(score) - self.k] - 1e-9
            at = np.flatnonzero((score >= cut) & (score > -np.inf))
            exact = (x[at] * self.x[i]).sum(1) / (norm[at] * self.norm[i])
            top = _best(exact, ids[at], rows[at], self.k)
            yield i, at[top], exact[top]


def exact_neighbours(index: DataFrame, probes: pd.DataFrame, k: int) -> DataFrame:
    """(q_row, rank, row, vec_id, score, leaf): the k nearest of every probe (row, v, width) among all rows.

    One pass; every task keeps k rows a probe.
    """
    shared = index.sparkSession.sparkContext.broadcast({int(w): (_scaled(p["v"]), p["row"].to_numpy(np.int64)) for w, p in probes.groupby("width")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = {w: _Against(x, rows, k) for w, (x, rows) in shared.value.items()}
        kept: dict[tuple[int, int], pd.DataFrame] = {}
        for b in batches:
            for width, part in b.groupby("width"):
                rows, ids, leaf = (part[c].to_numpy() for c in ("row", "vec_id", "leaf"))
                for i, at, score in asked[int(width)].best(_scaled(part["v"]), rows, ids):
                    new = np.rec.fromarrays([rows[at], ids[at], score, leaf[at]], names="row,vec_id,score,leaf")
                    both = np.concatenate([kept[width, i], new]) if (width, i) in kept else new
                    kept[width, i] = both[_best(both["score"], both["vec_id"], both["row"], k)]
        for (width, i), found in kept.items():
            yield pd.DataFrame(found).assign(q_row=asked[int(width)].rows[i])[["q_row", "row", "vec_id", "score", "leaf"]]

    widths = [int(w) for w in probes["width"].unique()]
    found = index.where(F.col("width").isin(widths)).select("row", "vec_id", "v", "width", "leaf").mapInPandas(run, "q_row long, row long, vec_id long, score double, leaf int")
    w = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def calibrate(trees: dict[int, Tree], index: DataFrame, k: int, target: float) -> None:
    """Set each tree's visits to the least number that finds ``target`` of the probes' neighbours."""
    probes = _chosen(index, "probe", PROBES, SAMPLE_VALUES)
    if not len(probes):
        return
    leaves = {q: part["leaf"].tolist() for q, part in exact_neighbours(index, probes, k).toPandas().groupby("q_row")}  # k rows a probe
    for width, part in probes.groupby("width"):
        tree, needed = trees[int(width)], []
        for row, unit in zip(part["row"], _unit(_scaled(part["v"])), strict=True):
            order = {leaf: i + 1 for i, leaf in enumerate(tree.walk(unit))}
            needed += [order[leaf] for leaf in leaves.get(row, [])]
        if needed:
            tree.visits = int(np.sort(needed)[max(0, int(np.ceil(target * len(needed))) - 1)])


def _packed(part: pd.DataFrame, kind: str) -> dict:
    x = np.stack([np.asarray(a, kind) for a in part["v"]])
    return {"n": np.int32(len(part)), "rows": part["row"].to_numpy(np.int64).tobytes(), "ids": part["vec_id"].to_numpy(np.int64).tobytes(), "values": x.tobytes()}


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, target: float = 0.96, visits: int | None = None,
            id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score, q_row: the k nearest that each query finds.

    ``visits`` sets the number of leaves and leaves the calibration out.
    """
    rows = usable(vectors, is_query, id_col, vector)
    trees, index = build(rows)
    if visits is None:
        calibrate(trees, index, k, target)
    for tree in trees.values():
        tree.visits = visits or tree.visits
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    kind = "<f4" if rows.schema["v"].dataType.elementType.typeName() == "float" else "<f8"

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
            while len(rest):
                width, leaf = int(rest["width"].iloc[0]), int(rest["leaf"].iloc[0])
                other = ((rest["width"] != width) | (rest["leaf"] != leaf)).to_numpy()
                end, size = int(other.argmax()) if other.any() else len(rest), max(1, BLOCK_VALUES // width)
                if end == len(rest) and end < size:
                    break  # the leaf may go on in the next batch
                end = min(end, size)
                yield pd.DataFrame([{"width": width, "leaf": leaf, **_packed(rest.iloc[:end], kind)}])
                rest = rest.iloc[end:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield pd.DataFrame([{"width": int(rest["width"].iloc[0]), "leaf": int(rest["leaf"].iloc[0]), **_packed(rest, kind)}])

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for width, part in b.groupby("width"):
                tree, wanted = shared.value[int(width)], {}
                for i, unit in enumerate(_unit(_scaled(part["v"]))):
                    for leaf in tree.visited(unit, k + 1):
                        wanted.setdefault(leaf, []).append(i)
                made = [{"q_width": int(width), "q_leaf": leaf, **{f"q_{c}": x for c, x in _packed(part.iloc[who[i:i + QUERY_BLOCK]], kind).items()}}
                        for leaf, who in wanted.items() for i in range(0, len(who), QUERY_BLOCK)]
                for i in range(0, len(made), 64):
                    yield pd.DataFrame(made[i:i + 64])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                q = _Against(_scaled(np.frombuffer(r.q_values, kind).reshape(r.q_n, -1)), np.frombuffer(r.q_rows, np.int64), k)
                q_ids, row, ids = (np.frombuffer(x, np.int64) for x in (r.q_ids, r.rows, r.ids))
                found = [(np.full(len(at), q.rows[i]), np.full(len(at), q_ids[i]), row[at], ids[at], score)
                         for i, at, score in q.best(_scaled(np.frombuffer(r.values, kind).reshape(r.n, -1)), row, ids)]
                yield pd.DataFrame(dict(zip(("q_row", "query_id", "row", "vec_id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    stored = (index.select("row", "vec_id", "v", "width", "leaf").repartitionByRange("width", "leaf", "row").sortWithinPartitions("width", "leaf", "row")
              .mapInPandas(blocks, "width int, leaf int, n int, rows binary, ids binary, values binary"))
    queries = index.where("query").select("row", "vec_id", "v", "width").mapInPandas(asked, "q_width int, q_leaf int, q_n int, q_rows binary, q_ids binary, q_values binary")
    pairs = written(stored, "blocks").join(written(queries, "asked"), (F.col("width") == F.col("q_width")) & (F.col("leaf") == F.col("q_leaf")))
    w = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return (pairs.mapInPandas(compare, _FOUND).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "q_row"))
