"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

The model scores ``w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``. The
pairwise part is computed in linear time by the sum-of-squares identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.
It is fitted on a bounded sample of labelled rows (``max_rows``) and scored on
every row of every text.

Defined results: a null or empty text has the features of an empty text and
gets a score; a null ``n_chars`` (or a table without it) has its own feature;
repeated rows are scored one by one; with no labelled rows at all, or labels of
one class only, every score is that class's smoothed share.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_DIM = 1 << 12
BINS = 12
#: Structure statistics, each a share from 0 to 1 or a scaled logarithm.
STATS = ("lower", "upper", "digit", "space", "line", "punct", "high", "distinct", "top", "adjacent",
         "odd_end", "no_letter", "repeat_line", "word_len", "n_words", "n_bytes")
META = ("n_chars", "n_chars_off")
N_STATS = len(STATS) + len(META)
DIM = WORD_DIM + N_STATS * BINS

#: Class of each byte: lower, upper, digit, blank, line feed, other ASCII, part of a longer character.
_CLASS = np.full(256, 5, np.int64)
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 13]] = 3
_CLASS[10] = 4
_CLASS[128:] = 6

_WORD = re.compile(r"\S+")


def structure(text: str, n_chars: float | None) -> list[float]:
    """The statistics of ``STATS`` and ``META`` for one text, each in 0..1."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=7) / size
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = text.split("\n")
    odd = sum(not w[-1].isalnum() and w[-1] not in ".," for w in words)
    no_letter = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    adjacent = sum(map(str.__eq__, words, words[1:]))
    stats = [*kinds.tolist(), len(counts) / n, max(counts.values(), default=0) / n, adjacent / n, odd / n, no_letter / n,
             1 - len(set(lines)) / len(lines), min(1.0, len(text) / n / 24), min(1.0, np.log2(1 + len(words)) / 16), min(1.0, np.log2(1 + len(raw)) / 20)]
    if n_chars is None or not np.isfinite(n_chars):
        return [*stats, float("nan"), float("nan")]
    off = abs(n_chars - len(text)) / max(len(text), 1)
    return [*stats, min(1.0, np.log2(1 + max(n_chars, 0)) / 20), min(1.0, off)]


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of one whole text: indices (each once) and values."""
    text = text or ""
    counts: Counter = Counter()
    for word, c in Counter(text.lower().split()).items():
        counts[zlib.crc32(word.encode("utf-8", "surrogatepass")) & (WORD_DIM - 1)] += c
    idx = np.fromiter(counts.keys(), np.int64, len(counts))
    val = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    val /= max(np.sqrt((val ** 2).sum()), 1e-9)
    stats = np.array(structure(text, n_chars))
    # square-root spacing: most statistics are small shares
    bins = np.where(np.isnan(stats), BINS - 1, np.minimum(BINS - 2, np.sqrt(np.nan_to_num(stats)) * (BINS - 1)))
    hot = WORD_DIM + np.arange(N_STATS) * BINS + bins.astype(np.int64)
    return np.concatenate([idx, hot]), np.concatenate([val, np.full(N_STATS, 0.3)])


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray  # DIM
    factors: np.ndarray  # DIM x rank

    def raw(self, idx: np.ndarray, val: np.ndarray) -> float:
        vx = self.factors[idx] * val[:, None]
        pair = 0.5 * ((vx.sum(0) ** 2).sum() - (vx ** 2).sum())
        return float(self.bias + self.linear[idx] @ val + pair)

    def probability(self, idx: np.ndarray, val: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(idx, val), -40, 40))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = 8, epochs: int = 6,
        rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> FactorisationMachine:
    """Logistic loss, AdaGrad, one row at a time in a seeded order."""
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    model = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(DIM), rng.normal(0, 0.02, (DIM, rank)))
    if len(set(labels.tolist())) < 2:
        model.factors[:] = 0
        return model
    g_bias, g_lin, g_fac = 1e-2, np.full(DIM, 1e-2), np.full((DIM, rank), 1e-2)
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            idx, val = rows[r]
            v = model.factors[idx]
            vx = v * val[:, None]
            total = vx.sum(0)
            raw = model.bias + model.linear[idx] @ val + 0.5 * ((total ** 2).sum() - (vx ** 2).sum())
            err = 1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40))) - labels[r]
            if abs(err) < 1e-4:
                continue
            d_lin = err * val + decay * model.linear[idx]
            d_fac = err * (val[:, None] * total - v * (val ** 2)[:, None]) + decay * v
            g_bias += err * err
            g_lin[idx] += d_lin ** 2
            g_fac[idx] += d_fac ** 2
            model.bias -= rate * err / np.sqrt(g_bias)
            model.linear[idx] -= rate * d_lin / np.sqrt(g_lin[idx])
            model.factors[idx] -= rate * d_fac / np.sqrt(g_fac[idx])
    return model


def _n_chars(docs: DataFrame) -> Column:
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_rows: int = 6000, **options) -> FactorisationMachine:
    """Fit on at most ``max_rows`` labelled rows (those of the smallest id hash, one of each id: the smallest by text hash).

    ``learn``: a condition on ``doc_id``; rows that fail it are never seen.
    Labels other than 0 and 1, and ids with both labels, are left out.
    """
    marks = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .select("doc_id", F.col("quality").cast("int").alias("y")))
    if learn is not None:
        marks = marks.where(learn)
    marks = (marks.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y_max")).where("y = y_max")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("doc_id", "y"))
    picked = docs.select("doc_id", "text", _n_chars(docs).alias("n_chars")).join(F.broadcast(marks), "doc_id")  # max_rows pairs
    # rows of a repeated id are cut to one here, before anything is collected
    picked = picked.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "n_chars", "y")).alias("r")).select("doc_id", "r.text", "r.n_chars", "r.y")

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [features(t, n) for t, n in zip(b["text"], b["n_chars"], strict=True)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "idx": [i.astype(np.int32) for i, _ in found],
                                "val": [v.astype(np.float32) for _, v in found]})

    # sparse features of at most WORD_DIM + N_STATS entries for each sampled row
    got = picked.mapInPandas(featurise, "doc_id long, y int, idx array<int>, val array<float>").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    rows = [(np.asarray(i, np.int64), np.asarray(v, np.float64)) for i, v in zip(got["idx"], got["val"], strict=True)]
    return fit(rows, got["y"].to_numpy(np.float64), **options)


def score_column(docs: DataFrame, model: FactorisationMachine) -> Column:
    """A column with the probability of quality 1 for every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series, n_chars: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.probability(*features(t, n)) for t, n in zip(text, n_chars, strict=True)], dtype="float64")

    return score(F.col("text"), _n_chars(docs))
