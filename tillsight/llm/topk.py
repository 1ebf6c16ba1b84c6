"""Exact top-k by inner product with a pivot-distance index.

Vectors are integers (``floor(scale * x)``). One more coordinate,
``sqrt(R - |x|^2)`` with R the largest squared norm, gives all of them the same
length, so the largest inner products are the smallest Euclidean distances:
``d(q, x)^2 = |q|^2 + R - 2 q.x``. Pivots come from a bounded sample.

Every vector is keyed by its nearest pivot and its distance to it, and stored in
blocks: runs of at most ``BLOCK`` vectors of one pivot in order of distance, each
with its annulus [low, high]. Queries are stored in the same way. A first join
compares each block of queries with the blocks of its own pivot whose annuli
are next to it, which bounds each query's k-th score from below, hence its radius r. Then,
for every pivot p, only annuli that meet [d(q, p) - r, d(q, p) + r] for some q of the block can hold a better
or equal vector (triangle inequality); the others are never read. Scores are
exact integers, ties go to the smaller id.

Defined results: rows without id and vectors that are null, empty or hold null or
non-finite components take no part; vectors are compared with those of their own length, which has pivots
of its own; a query's own row is no candidate, other rows that repeat its id or its vector are; rows that repeat an id are
queries and candidates of their own; fewer candidates than k give them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BLOCK, QUERY_BLOCK = 2048, 512
#: Bound of the sample that pivots are chosen from, and their number.
SAMPLE, PIVOTS = 2048, 16
LEAST = np.iinfo(np.int64).min
#: Blocks that a block of queries is compared with first, to get its floors.
SEEDS = 2
_STORED = "cell int, block string, low double, high double, n int, width int, rows binary, ids binary, values binary"


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, v, length): whole components of the vectors that take part, each row with a number of its own."""
    v = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    usable = F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND vec_id IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    found = vectors.where(usable).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return written(found.withColumn("length", F.size("v")), "vectors")


@dataclass
class Pivots:
    """The pivots of one length (with the added coordinate), the largest squared norm and the number of the first cell."""

    at: np.ndarray
    radius: float
    first: int


def choose_pivots(vectors: DataFrame) -> dict[int, Pivots]:
    """Pivots by length. Farthest-first over the rows of smallest hash, ``SAMPLE`` over all lengths (one of each at least)."""
    norm = F.expr("aggregate(v, 0D, (s, x) -> s + cast(x AS double) * x)")
    radius = {r.length: float(r.radius) for r in vectors.groupBy("length").agg(F.max(norm).alias("radius")).collect()}  # a row per length
    w = Window.partitionBy("length").orderBy(F.xxhash64("vec_id"), "vec_id", "row")
    kept = vectors.withColumn("place", F.row_number().over(w)).where(F.col("place") <= max(1, SAMPLE // max(len(radius), 1)))
    out: dict[int, Pivots] = {}
    cells = 0
    for length, got in kept.select("length", "v").toPandas().groupby("length"):  # bounded by SAMPLE and a row per length
        x = lifted(np.stack(got["v"].to_numpy()).astype(np.float64), radius[length])
        picked, away = [0], ((x - x[0]) ** 2).sum(1)
        while len(picked) < min(PIVOTS, len(x)) and away.max() > 0:
            picked.append(int(away.argmax()))
            away = np.minimum(away, ((x - x[picked[-1]]) ** 2).sum(1))
        out[int(length)] = Pivots(x[picked], radius[length], cells)
        cells += len(picked)
    return out


def lifted(x: np.ndarray, radius: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(radius - (x ** 2).sum(1), 0.0))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots ** 2).sum(1), 0.0))


def keyed(vectors: DataFrame, pivots: dict[int, Pivots]) -> DataFrame:
    """(row, vec_id, v, cell, dist): nearest pivot of its length and the distance to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for length, part in b.groupby("length"):
                p = pivots[int(length)]
                d = _distances(lifted(np.stack(part["v"].to_numpy()).astype(np.float64), p.radius), p.at)
                cell = d.argmin(1)
                yield part.drop(columns="length").assign(cell=(p.first + cell).astype(np.int32), dist=d[np.arange(len(part)), cell])

    return vectors.mapInPandas(run, "row long, vec_id long, v array<long>, cell int, dist double")


def stored(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of at most ``size`` vectors: range partitions in (cell, distance) order, cut at pivots.

    The row is among the range keys, so a vector or an id that repeats very often is spread too.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, made = None, 0
        for b in batches:
            rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
            while len(rest):
                same = (rest["cell"] == rest["cell"].iloc[0]).to_numpy()
                end = len(rest) if same.all() else int(same.argmin())
                if end == len(rest) and end < size:
                    break  # the pivot may go on in the next batch
                end, made = min(end, size), made + 1
                yield _block(rest.iloc[:end], made)
                rest = rest.iloc[end:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield _block(rest, made + 1)

    sorted_rows = rows.repartitionByRange("cell", "dist", "vec_id", "row").sortWithinPartitions("cell", "dist", "vec_id", "row")
    return written(sorted_rows.mapInPandas(run, _STORED), name)


def _block(rows: pd.DataFrame, made: int) -> pd.DataFrame:
    x = np.stack(rows["v"].to_numpy()).astype(np.int64)
    big = int(np.abs(x).max())
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if big <= np.iinfo(t).max)
    cell, ids = int(rows["cell"].iloc[0]), rows["vec_id"].to_numpy(np.int64)
    name = f"{cell}-{rows['row'].iloc[0]}-{made}"
    return pd.DataFrame({"cell": [np.int32(cell)], "block": [name], "low": [float(rows["dist"].iloc[0])], "high": [float(rows["dist"].iloc[-1])],
                         "n": [np.int32(len(rows))], "width": [np.int32(np.dtype(kind).itemsize)], "rows": [rows["row"].to_numpy(np.int64).tobytes()], "ids": [ids.tobytes()], "values": [x.astype(kind).tobytes()]})


def _matrix(values: bytes, width: int, n: int) -> np.ndarray:
    return np.frombuffer(values, f"<i{width}").reshape(n, -1).astype(np.float64)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floats where every sum stays below 2^53."""
    if (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * q.shape[1] < 2 ** 53:
        return np.rint(q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by (score descending, id ascending)."""
    if len(ids) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


_FOUND = "q_block string, q_row long, query_id long, row long, vec_id long, score long"


def _floors(rows: np.ndarray, known) -> tuple[np.ndarray, np.ndarray]:
    """Score and id of each query's k-th best so far; the least number and any id where none is known."""
    floor = {} if known is None else {f["q_row"]: (f["floor"], f["last"]) for f in known}
    got = np.array([floor.get(i, (LEAST, 0)) for i in rows.tolist()], np.int64).reshape(-1, 2)
    return got[:, 0], got[:, 1]


def _compare(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of each query in each pair of blocks; with a floor, only those at least as good as the k-th best so far."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                q_row, qid, row, vid = (np.frombuffer(x, np.int64) for x in (r.q_rows, r.q_ids, r.rows, r.ids))
                scores = _scores(_matrix(r.q_values, r.q_width, r.q_n), _matrix(r.values, r.width, r.n))
                floors, last = _floors(q_row, r.floors)
                out = []
                for i, q in enumerate(q_row):
                    better = (scores[i] > floors[i]) | ((scores[i] == floors[i]) & (vid <= last[i]))  # ties at the floor go to smaller ids
                    at = np.flatnonzero((better | (floors[i] == LEAST)) & (row != q))
                    at = at[_best(vid[at], scores[i][at], k)]
                    out.append((np.full(len(at), q), np.full(len(at), qid[i]), row[at], vid[at], scores[i][at]))
                found = dict(zip(("q_row", "query_id", "row", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True))
                yield pd.DataFrame({"q_block": np.full(len(found["score"]), r.q_block, object), **found})

    return pairs.mapInPandas(run, _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best among all other rows.

    ``is_query``: a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, scale)
    pivots = choose_pivots(rows)
    if not pivots:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    of_cell = {p.first + i: p for p in pivots.values() for i in range(len(p.at))}
    index = keyed(rows, pivots)
    blocks = stored(index, BLOCK, "blocks")
    asked = stored(index.where(is_query), QUERY_BLOCK, "queries").select(
        F.col("cell").alias("q_cell"), F.col("block").alias("q_block"), F.col("low").alias("q_low"), F.col("high").alias("q_high"),
        F.col("n").alias("q_n"), F.col("width").alias("q_width"), F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"))

    # first annuli: those of the own pivot nearest to the queries' annulus; any choice gives valid floors
    gap = F.abs(F.col("low") + F.col("high") - F.col("q_low") - F.col("q_high"))
    near = (asked.select("q_cell", "q_block", "q_low", "q_high").join(blocks.select("cell", "block", "low", "high"), F.col("cell") == F.col("q_cell"))
            .withColumn("place", F.row_number().over(Window.partitionBy("q_block").orderBy(gap, "block"))).where(F.col("place") <= SEEDS).select("q_block", "block"))
    none = F.lit(None).cast("array<struct<q_row: bigint, floor: bigint, last: bigint>>")
    seed = _top(_compare(near.join(blocks, "block").join(asked, "q_block").withColumn("floors", none), k), k)
    worst = F.struct(F.col("score"), -F.col("vec_id"))  # the least score, of equal ones the largest id
    floor = seed.groupBy("q_block", "q_row").agg(F.min(worst).alias("w"), F.count("*").alias("n")).where(F.col("n") == k)
    floor = floor.groupBy("q_block").agg(F.collect_list(F.struct("q_row", F.col("w.score").alias("floor"), (-F.col("w.col2")).alias("last"))).alias("floors"))  # at most QUERY_BLOCK
    with_floor = written(asked.join(floor, "q_block", "left"), "asked")

    def annuli(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                q, p = _matrix(r.q_values, r.q_width, r.q_n), of_cell[r.q_cell]
                floors, _ = _floors(np.frombuffer(r.q_rows, np.int64), r.floors)
                norm = (q ** 2).sum(1)
                reach = np.where(floors == LEAST, np.inf, np.sqrt(np.maximum(norm + p.radius - 2.0 * floors.astype(np.float64), 0.0)))
                slack = 1e-6 * (1.0 + np.sqrt(norm.max() + p.radius))  # rounding of the distances
                d = _distances(np.hstack([q, np.zeros((len(q), 1))]), p.at)
                yield pd.DataFrame({"q_block": r.q_block, "cell": np.arange(p.first, p.first + len(p.at), dtype=np.int32),
                                    "from": (d - reach[:, None]).min(0) - slack, "to": (d + reach[:, None]).max(0) + slack})

    wanted = with_floor.mapInPandas(annuli, "q_block string, cell int, from double, to double")
    pairs = (wanted.join(blocks.select("cell", "block", "low", "high"), "cell").where("low <= to AND high >= from").select("q_block", "block"))
    found = _compare(pairs.join(blocks, "block").join(with_floor, "q_block"), k)
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
