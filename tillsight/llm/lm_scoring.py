"""LM scoring: a causal self-attention model over subword ids, and a unigram base.

Base: the corpus counts every word of every training text; counts are summed
per 64-bit word hash by Spark and joined back to the documents' words. The
``COMMON`` most frequent words travel to the tasks as a table of fixed size; all
other words go through a shuffle join, so the result covers every word.

Model: texts become subword ids of a public tokenizer plus an end id. Ids fall
into ``CLASSES`` classes: one for each of the most frequent ids of the training
texts, the others spread by id. A token's probability is that of its class,
from a one-head causal attention layer over the window on top of the classes seen after
the id before it, times that of the id within its class, given the id before it (backed
off to the class before it, then to its frequency, add-one over all ids of the class).
Ids, pairs of ids and (class, id) are counted over all training texts by Spark. What
the vocabulary bounds travels to the tasks, with the ``COMMON_PAIRS`` most frequent pairs;
all other pairs go through a shuffle join, as the words do.
The layer is trained in numpy on all training windows, each at least once. They are dealt by hash of id, text and
place to groups of about ``GROUP_WINDOWS``, which train side by side from one start, and their tables are
averaged, so no task or driver holds all windows. Texts are scored whole: windows of ``WINDOW`` ids overlap by
``WINDOW - STRIDE``, each id is scored once, in the first window that holds it, and
the windows of many texts go through one masked batch.

Defined results: a null or empty text is the end token alone; rows are scored one
by one; without training documents the counts are zero and the model is uniform
over its classes; a row with a null id is a training row (its remainder is null).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written
from .near_dup import _mix
from .tokenizing import byte_level

END_ID, IDS = 50256, 50257
#: The mark before the first id of a text.
START = IDS
CLASSES, SINGLE = 128, 112
WINDOW, STRIDE, WIDTH = 32, 24, 8
CAUSAL = np.tri(WINDOW, dtype=np.float32)
#: Windows of a group, least steps of its training (small groups go over their windows again), and windows of a step.
GROUP_WINDOWS, STEPS, BATCH = 64_000, 300, 128
#: Weight of an id's own frequency against its frequency after a class, and of that against the one after an id.
BACK_OFF, BACK_OFF_ID = 5.0, 2.0
COMMON, COMMON_PAIRS = 1 << 16, 1 << 20
#: Ids whose pairs a task sorts at once, and distinct pairs it holds before it hands their counts on.
SORT_IDS, HELD_PAIRS = 1 << 22, 1 << 21
#: Bytes that are no part of a word; what each byte (A-Z as a-z) and each place counts for in a word's hash; bytes that are hashed at once.
BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
BYTES = np.random.default_rng(11).integers(1, 1 << 64, 256, np.uint64)
BYTES[65:91] = BYTES[97:123]
STEP, HASH_BYTES = 0x9E3779B97F4A7C15, 1 << 15
#: Bits beside a pair's key (below 2**32) for its place among those looked up at once.
KEY_BITS = 32
#: Fills a stored window up.
PAD = 0xFFFF
#: Ids that are gathered for the model, windows that go through it together, and the scores it takes unshifted.
BATCH_IDS, MANY, BOUND = 60_000, 128, 60.0


@functools.lru_cache(1)
def _places(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``STEP`` to the power of each place, and the inverses, modulo 2**64."""
    up, down = np.full(size, STEP, np.uint64), np.full(size, pow(STEP, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts``, and the place of each text's first one, then their number.

    A word is a run of bytes outside ASCII white space, A-Z lower-cased; a hash sums a number for each byte times ``STEP`` to
    the power of its place in the word. Whole batches of bytes are hashed at once: one call a word cost three times as much.
    """
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    blank = BLANK.take(data)
    after, before = np.append(True, blank), np.append(blank, True)  # blanks and ends of texts around each byte
    after[ends] = before[ends] = True
    begin, end = np.flatnonzero(after[:-1] > blank), np.flatnonzero(before[1:] > blank) + 1
    found, at = np.empty(len(begin), np.uint64), 0
    up, down = _places(HASH_BYTES)
    while at < len(begin):
        low, to = begin[at], int(np.searchsorted(end, begin[at] + HASH_BYTES, "right"))
        if to > at:
            sums = np.zeros(end[to - 1] - low + 1, np.uint64)
            np.cumsum(BYTES.take(data[low:end[to - 1]]) * up[:len(sums) - 1], out=sums[1:])
            found[at:to] = (sums[end[at:to] - low] - sums[begin[at:to] - low]) * down[begin[at:to] - low]
        else:  # a word that is longer than that
            to, h, turn = at + 1, 0, 1
            for some in np.split(data[low:end[at]], range(HASH_BYTES, int(end[at] - low), HASH_BYTES)):
                h += int((BYTES.take(some) * up[:len(some)]).sum(dtype=np.uint64)) * turn
                turn = turn * pow(STEP, HASH_BYTES, 1 << 64) % (1 << 64)
            found[at] = h % (1 << 64)
        at = to
    return found.view(np.int64), np.searchsorted(begin, ends)


def classes_of(counts: np.ndarray) -> np.ndarray:
    """The class of each id by the counts of the ids, then that of START."""
    classes = SINGLE + np.arange(IDS) % (CLASSES - SINGLE)
    top = np.argsort(-counts.astype(np.float64), kind="stable")[:SINGLE]
    classes[top] = np.arange(SINGLE)
    return np.append(classes, CLASSES)


@functools.cache
def touch_products() -> None:
    """One product that fills OpenBLAS's buffer, once a process: thin products on a fresh buffer took four times as long."""
    square = np.ones((512, 512), np.float32)
    np.matmul(square, square)


def powers(t: np.ndarray, halvings: int, out: np.ndarray) -> np.ndarray:
    """exp(t * 2**halvings) for ``t`` up to 1/8, from its series, squared: off by about 3e-7 * 2**halvings of it at most.

    numpy has ``exp`` as a loop over single numbers on some processors; these are steps over whole arrays.
    """
    np.multiply(t, np.float32(1 / 24), out=out)
    for term in (1 / 6, 1 / 2, 1):
        out += np.float32(term)
        out *= t
    out += np.float32(1)
    for _ in range(halvings):
        out *= out
    return out


def row_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sums of products over the last, short axis."""
    return np.einsum("...k,...k->...", a, b)


def with_ones(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of each window with a one behind them, and the windows turned round in memory: products with these take half the time."""
    ends, turned = np.empty((*e.shape[:2], WIDTH + 1), e.dtype), np.empty((len(e), WIDTH + 1, e.shape[1]), e.dtype)
    ends[..., :WIDTH], turned[:, :WIDTH] = e, e.transpose(0, 2, 1)
    ends[..., WIDTH], turned[:, WIDTH] = 1, 1
    return ends, turned


def halvings(most: float) -> int:
    """How often a range up to ``most`` is halved for :func:`powers`."""
    return max(0, math.ceil(math.log2(8 * min(most, BOUND)))) if most else 0


@dataclass
class AttentionModel:
    counts: np.ndarray  # how often each id occurs
    after: tuple[np.ndarray, np.ndarray]  # places in ``inside`` of ids seen after a class, and how often
    classes: np.ndarray  # class of each id, then that of START
    inside: np.ndarray  # probability of each id within its class, by the class before it
    pairs: np.ndarray  # sorted keys of pairs (id before, id): the most frequent ones
    times: np.ndarray  # how often each occurs
    led: np.ndarray  # how often each class follows each id
    first: np.ndarray  # log probability of each class after each id
    p: dict[str, np.ndarray]
    bound: float = math.inf
    learning: bool = field(default=False, init=False, repr=False)
    kept: dict[str, np.ndarray] = field(default_factory=dict, init=False, repr=False)

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array that is used again under its name: pages of fresh memory cost more than the sums in them."""
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, np.float32)
        return self.kept[name][:size].reshape(shape)

    @staticmethod
    def start(before: np.ndarray, ids: np.ndarray) -> AttentionModel:
        """Classes and id probabilities from pairs of ids (``before`` negative: the start of a text)."""
        counts = np.bincount(ids, minlength=IDS)
        before = np.where(before >= 0, before, START)
        known = classes_of(counts)
        inside, led = np.zeros((CLASSES + 1, IDS), np.float32), np.zeros((IDS + 1, CLASSES), np.float32)
        np.add.at(inside, (known[before], ids), 1)
        np.add.at(led, (before, known[ids]), 1)
        pairs, times = np.unique(before * IDS + ids, return_counts=True)
        return AttentionModel.counted(counts, inside, led, pairs, times)

    @staticmethod
    def counted(counts: np.ndarray, inside: np.ndarray, led: np.ndarray, pairs: np.ndarray, times: np.ndarray, seed: int = 3) -> AttentionModel:
        """From the counts of ids, of ids after each class (``inside``, overwritten), of classes after each id and of pairs."""
        known = classes_of(counts)
        classes = known[:-1]
        total = np.bincount(classes, counts + 1.0, minlength=CLASSES)
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 0.1, s)
        p = {"emb": draw(CLASSES + 1, WIDTH), "pos": draw(WINDOW, WIDTH), "q": draw(WIDTH, WIDTH), "k": draw(WIDTH, WIDTH), "v": draw(WIDTH, WIDTH),
             "o": draw(WIDTH, WIDTH), "out": np.zeros((WIDTH, CLASSES)), "pair": np.zeros((CLASSES + 1, CLASSES))}
        alone = (counts + 1) / total[classes]
        after_at = np.flatnonzero(inside).astype(np.int32)
        after_class = after_at, inside.ravel()[after_at]
        next_class = np.zeros((CLASSES + 1, CLASSES))
        for row, after in zip(inside, next_class, strict=True):  # counts after this class, backed off to those of the id alone
            seen = np.bincount(classes, row, minlength=CLASSES)
            after[:] = (seen + BACK_OFF * total / total.sum()) / (seen.sum() + BACK_OFF)
            row[:] = (row + BACK_OFF * alone) / (seen[classes] + BACK_OFF)
        first = (np.float32(BACK_OFF_ID) * next_class.astype(np.float32))[known]
        first += led
        first /= led.sum(1, keepdims=True) + np.float32(BACK_OFF_ID)
        np.log(first, out=first)
        return AttentionModel(counts, after_class, known, inside, pairs, times.astype(np.float32), led, first, p)

    def __reduce__(self):
        """Only counts that are not zero travel; the tables are built again from them."""
        at = np.flatnonzero(self.led).astype(np.int32)
        return _rebuilt, (self.counts, self.after, (at, self.led.ravel()[at]), self.pairs, self.times, self.p, math.isfinite(self.bound))

    def held(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each pair occurs, and whether ``pairs`` holds it."""
        if not len(self.pairs):
            return np.zeros(len(key), np.float32), np.zeros(len(key), bool)
        order = np.sort(key.astype(np.uint64) << np.uint64(KEY_BITS) | np.arange(len(key), dtype=np.uint64))  # keys in order find their places near one another
        at = np.empty(len(key), np.int64)
        at[(order & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64)] = np.searchsorted(self.pairs, (order >> np.uint64(KEY_BITS)).astype(np.int64))
        at = np.minimum(at, len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.times[at], np.float32(0)), hit

    def prior(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """What a pair counts for besides its occurrences."""
        return np.float32(BACK_OFF_ID) * self.inside.ravel().take(self.classes.take(before) * IDS + ids)

    def log_inside(self, before: np.ndarray, ids: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each id within its class, after the id ``before`` it."""
        if times is None:
            times, _ = self.held(before * IDS + ids)
        return np.log((times + self.prior(before, ids)) / (self.led.ravel().take(before * CLASSES + self.classes.take(ids)) + np.float32(BACK_OFF_ID)))

    def forward(self, x: np.ndarray) -> tuple[np.ndarray | None, tuple]:
        """Logits for the class after each position of the id windows ``x`` (None while ``learning``), in arrays that the next call overwrites."""
        p, before, n = self.p, self.classes.take(x), x.size
        e = p["emb"].take(before, axis=0)
        e += p["pos"][:x.shape[1]]
        ends, turned = with_ones(e)
        u = (e.reshape(-1, WIDTH) @ (p["q"] @ p["k"].T / np.float32(math.sqrt(WIDTH)))).reshape(e.shape)  # queries by keys: one table
        a, raw = (self.room(name, *x.shape, x.shape[1]) for name in ("a", "raw"))
        most = math.sqrt(float(row_products(u, u).max(initial=0)) * float(row_products(e, e).max(initial=0)))  # no product of a row and a column is larger
        if most > BOUND:
            np.matmul(u, turned[:, :WIDTH], out=a)
            a += np.triu(np.full(a.shape[1:], -1e9, e.dtype), 1)
            a -= a.max(-1, keepdims=True)
            np.exp(a, out=a)
        else:
            k = halvings(most)
            powers(np.matmul(u / np.float32(2 ** k), turned[:, :WIDTH], out=raw), k, a)
        a *= CAUSAL[:x.shape[1], :x.shape[1]]
        c = a @ ends  # the last column sums the weights
        c, total = c[..., :WIDTH] / c[..., WIDTH:], c[..., WIDTH:]
        h = np.tanh((c.reshape(-1, WIDTH) @ (p["v"] @ p["o"])).reshape(e.shape) + e)
        if self.learning:
            return None, (e, turned, u, a, total, c, h)
        z, more = np.matmul(h.reshape(-1, WIDTH), p["out"], out=self.room("z", n, CLASSES)), self.room("more", n, CLASSES)
        z += p["pair"].take(before.ravel(), axis=0, out=more, mode="clip")
        z += self.first.take(x.ravel(), axis=0, out=more, mode="clip")
        return z.reshape(*x.shape, CLASSES), (e, turned, u, a, total, c, h)

    def odds_of(self, h: np.ndarray, ids: np.ndarray, n: np.ndarray, likely: np.ndarray) -> np.ndarray:
        """What each class weighs after each id, up to a factor a row: the exponentials of :meth:`forward`'s logits, in a reused array.

        Rows of ``h`` stand in runs of equal ids: each of ``ids`` comes ``n`` times. ``likely``: the exponentials of ``first``.
        """
        p, near = self.p, self.classes[ids]
        z, more = self.room("z", len(h), CLASSES), self.room("more", len(h), CLASSES)
        most = np.abs(p["out"]).sum(0).max()
        if most + np.abs(p["pair"]).max() > BOUND:
            np.matmul(h, p["out"], out=z)
            z += np.repeat(self.first[ids] + p["pair"][near], n, axis=0)
            z -= z.max(-1, keepdims=True)
            return np.exp(z, out=z)
        k = halvings(most)
        each = powers(np.matmul(h, p["out"] / np.float32(2 ** k), out=z), k, more)
        odds = likely.take(ids, axis=0)
        odds *= np.exp(p["pair"]).take(near, axis=0)
        each *= odds.take(np.repeat(np.arange(len(ids)), n), axis=0, out=z, mode="clip")
        return each

    def train(self, windows: np.ndarray, times: np.ndarray | None = None, seed: int = 4) -> None:
        """:meth:`fit`, and the tables for scoring."""
        self.fit(windows, times, seed)
        self.ready()

    def fit(self, windows: np.ndarray, times: np.ndarray | None = None, seed: int = 4) -> None:
        """Adam on cross entropy, in whole passes over ``windows`` (rows of WINDOW + 1 ids, START before a text, -1 pads), each weighed by its ``times``."""
        touch_products()
        near, likely = self.classes.astype(np.uint8), np.exp(self.first)
        ranked = np.argsort(self.classes, kind="stable")  # ids by class
        place = np.empty(IDS + 1, np.uint16)
        place[ranked] = np.arange(IDS + 1)
        rng = np.random.default_rng(seed)
        names = sorted(self.p)
        flat = np.concatenate([self.p[n].ravel() for n in names]).astype(np.float32)
        cuts = np.cumsum([self.p[n].size for n in names])[:-1]
        view = lambda m: {n: part.reshape(self.p[n].shape) for n, part in zip(names, np.split(m, cuts), strict=True)}
        slope, m1, m2 = (np.zeros_like(flat) for _ in range(3))
        g, p = view(slope), view(flat)
        self.p, self.learning = p, True
        weight = np.ones(len(windows), np.float32) if times is None else np.asarray(times, np.float32)
        passes = -(-STEPS // -(-len(windows) // BATCH)) if len(windows) else 0
        parts = (part for _ in range(passes) for order in [rng.permutation(len(windows))] for part in np.split(order, range(BATCH, len(order), BATCH)))
        rows = lambda m: m.reshape(-1, m.shape[-1])
        ones, root = np.ones(CLASSES, np.float32), np.float32(math.sqrt(WIDTH))
        numbers = np.arange(BATCH * WINDOW)
        back = np.empty_like(numbers)
        for step, part in enumerate(parts, 1):
            w = windows[part]
            x, on = np.maximum(w[:, :-1], 0), ((w[:, 1:] >= 0) * weight[part, None]).ravel()
            e, turned, u, a, total, c, h = self.forward(x)[1]
            x, y = x.ravel(), near.take(np.maximum(w[:, 1:], 0).ravel())
            at = place.take(x)
            order = np.argsort(at, kind="stable")  # rows of one class, and of one id, follow one another from here on
            at, y, on, late = at[order], y[order], on[order], rows(h).take(order, axis=0)
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            ids = ranked[at[begin]]
            z = self.odds_of(late, ids, np.diff(begin, append=len(at)), likely)
            run = np.flatnonzero(np.diff(self.classes[ids], prepend=-1))
            first, there = begin[run], self.classes[ids[run]]
            all_ = z @ ones
            spot = np.arange(0, z.size, CLASSES) + y
            z.ravel()[spot] -= all_
            share = on / max(on.sum(), np.float32(1)) / all_  # a row's slope is its row of z times this
            slope[:] = 0
            for at, low, high in zip(there.tolist(), first.tolist(), [*first[1:].tolist(), len(z)], strict=True):
                np.dot(share[low:high], z[low:high], out=g["pair"][at])
            share = share[:, None]
            g["out"][:] = (late * share).T @ z
            back[order] = numbers[:len(order)]
            dh = ((z @ p["out"].T) * (share - share * late * late)).take(back[:len(order)], axis=0)
            joined = rows(c).T @ dh  # the slope of v @ o
            g["v"][:], g["o"][:] = joined @ p["o"].T, p["v"].T @ joined
            dc = (dh @ (p["v"] @ p["o"]).T).reshape(c.shape) / total
            de = np.matmul(a.transpose(0, 2, 1), dc)
            de += dh.reshape(de.shape)
            a *= np.matmul(np.concatenate([dc, -row_products(dc, c)[..., None]], axis=2), turned, out=self.room("raw", *a.shape))  # the slope of the attention's logits
            s = a @ e
            mixed = rows(e).T @ rows(s) / root  # the slope of q @ k.T
            g["q"][:], g["k"][:] = mixed @ p["k"], mixed.T @ p["q"]
            de += (rows(s) @ (p["k"] @ p["q"].T / root)).reshape(de.shape)
            de += a.transpose(0, 2, 1) @ u
            g["pos"][:] = de.sum(0)
            g["emb"][there] = np.add.reduceat(rows(de).take(order, axis=0), first)
            m1 += np.float32(0.1) * (slope - m1)
            m2 += np.float32(0.01) * (slope * slope - m2)
            flat -= np.float32(0.02 / (1 - 0.9 ** step)) * m1 / (np.sqrt(m2 / np.float32(1 - 0.99 ** step)) + np.float32(1e-8))
        self.learning = False

    def log_class(self, w: np.ndarray) -> np.ndarray:
        """Log probability of the class after each position of id windows (rows of WINDOW + 1, -1 pads).

        A window that does not begin a text scores no position that the one before it scores; those are 0.
        """
        got = np.zeros((len(w), WINDOW), np.float32)
        begins = w[:, 0] == START
        for rows, skip in ((begins, 0), (~begins, WINDOW - STRIDE)):
            if rows.all():
                got[:, skip:] = self.log_class_from(w, skip)
            elif rows.any():
                got[rows, skip:] = self.log_class_from(w[rows], skip)
        return got

    def log_class_from(self, w: np.ndarray, skip: int) -> np.ndarray:
        """:meth:`log_class` of the positions from ``skip`` on, which see the whole window before them.

        Scores are bounded by the trained tables, so exponentials need no shift by a maximum (``first`` holds
        log probabilities, so some class of each row is near 0);
        tables beyond ``BOUND`` take the shifted form of ``forward``.
        """
        p, known = self.p, self.near.take(np.maximum(w, 0)).astype(np.int64)  # pads take any class: what they score is dropped
        x, y = w[:, :-1], known[:, 1 + skip:].ravel()
        if self.bound > BOUND:
            z = self.forward(np.maximum(x, 0))[0][:, skip:].reshape(-1, CLASSES)
            z = z - z.max(-1, keepdims=True)
            return (z[np.arange(len(z)), y] - np.log(np.exp(z).sum(-1))).reshape(len(w), -1)
        e = p["emb"].take(known[:, :-1], axis=0)
        e += p["pos"]
        late, (ends, turned) = np.ascontiguousarray(e[:, skip:]).reshape(-1, WIDTH), with_ones(e)
        a = np.matmul((late @ self.query).reshape(len(w), WINDOW - skip, WIDTH), turned[:, :WIDTH], out=self.room("z", len(w), WINDOW - skip, WINDOW))
        a = powers(a, self.reach, self.room("a", *a.shape))
        a *= CAUSAL[skip:]
        c = a @ ends  # the last column sums the weights
        c = (c[..., :-1] / c[..., -1:]).reshape(-1, WIDTH)
        h = np.tanh(c @ self.value + late)
        x = x[:, skip:].ravel()
        z, more = self.room("z", len(x), CLASSES), self.room("more", len(x), CLASSES)
        each = powers(np.matmul(h, self.part, out=z), self.halvings, more)
        odds = self.odds.take(x, axis=0, out=z, mode="clip")
        total = np.vecdot(each, odds)
        return (row_products(h, self.heads.take(y, axis=0)) + np.log(odds.ravel().take(np.arange(0, odds.size, CLASSES) + y) / total)).reshape(len(w), -1)

    def ready(self) -> None:
        """Tables that scoring reads."""
        touch_products()
        p = {n: w.astype(np.float32) for n, w in self.p.items()}
        e = (p["emb"][:, None] + p["pos"]).reshape(-1, WIDTH)
        reach = np.linalg.norm(e @ p["q"], axis=1).max() * np.linalg.norm(e @ p["k"], axis=1).max() / math.sqrt(WIDTH)
        most = float(np.abs(p["out"]).sum(0).max())
        self.bound = float(max(reach, most + np.abs(p["pair"]).max()))
        self.reach, self.halvings = halvings(reach), halvings(most)
        self.query, self.value = p["q"] @ p["k"].T / np.float32(math.sqrt(WIDTH) * 2 ** self.reach), p["v"] @ p["o"]
        self.odds = np.exp(self.first + p["pair"][self.classes])
        self.near = self.classes.astype(np.uint8)  # classes in a table that a core's cache holds
        self.part, self.heads = p["out"] / np.float32(2 ** self.halvings), np.ascontiguousarray(p["out"].T)
        self.p = p

    def score(self, texts: list[np.ndarray], rare: list[np.ndarray] | None = None) -> np.ndarray:
        """log10 probability of each id sequence (every one ends with the end id).

        ``rare`` gets the keys of each text's pairs that ``pairs`` does not hold; they score as unseen.
        """
        n = np.array([len(t) for t in texts])
        flat = np.full(n.sum() + len(n) + WINDOW, START, np.int64)  # each text after its start mark
        begin = np.cumsum(n + 1) - n - 1
        ids = np.concatenate(texts)
        flat[np.arange(len(ids)) + np.repeat(np.arange(1, len(n) + 1), n)] = ids
        count = 1 + -(-np.maximum(n - WINDOW, 0) // STRIDE)
        owner = np.repeat(np.arange(len(n)), count)
        first = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start, end = begin[owner] + first * STRIDE, (begin + n + 1)[owner]
        size, windows = end - start, np.lib.stride_tricks.sliding_window_view(flat, WINDOW + 1)
        total = np.zeros(len(n))
        order = np.argsort(first > 0, kind="stable")  # windows that begin a text, then the others, which score fewer ids
        for part in np.split(order, range(MANY, len(order), MANY)):
            w = windows[start[part]]
            w[np.arange(WINDOW + 1) >= size[part, None]] = -1
            total += np.bincount(owner[part], np.where(w[:, 1:] >= 0, self.log_class(w), 0).sum(1), minlength=len(n))
        before = np.delete(flat[:len(ids) + len(n)], (begin + n)) if len(n) else flat[:0]  # the id before each id
        key = before * IDS + ids
        times, hit = self.held(key)
        if rare is not None:
            rare.extend(k[~h] for k, h in zip(np.split(key, np.cumsum(n)[:-1]), np.split(hit, np.cumsum(n)[:-1]), strict=True))
        inside = np.add.reduceat(self.log_inside(before, ids, times).astype(np.float64), np.cumsum(n) - n)
        return (total + inside) / math.log(10)


def _dense(at: np.ndarray, n: np.ndarray, shape: tuple[int, ...], kind=np.float32) -> np.ndarray:
    out = np.zeros(shape, kind)
    out.ravel()[at] = n
    return out


def _rebuilt(counts: np.ndarray, after: tuple, led: tuple, pairs: np.ndarray, times: np.ndarray, p: dict, ready: bool) -> AttentionModel:
    model = AttentionModel.counted(counts, _dense(*after, (CLASSES + 1, IDS)), _dense(*led, (IDS + 1, CLASSES)), pairs, times)
    model.p = p
    if ready:
        model.ready()
    return model


def _ids(text: str | None, encode) -> np.ndarray:
    return np.append(np.frombuffer(encode(text), "<u4").astype(np.int64) if text else np.zeros(0, np.int64), END_ID)


def token_rows(docs: DataFrame, held_out: Column, tokenizer: str) -> DataFrame:
    """doc_id, held_out, text, ids (two bytes each) and n of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level(tokenizer).ids
        for batch in batches:
            ids = [_ids(t.as_py(), encode).astype("<u2") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(list(map(len, ids)), pa.int64())],
                                             names=["doc_id", "held_out", "text", "ids", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, text string, ids binary, n long")


def _stored_ids(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), "<u2").astype(np.int64)


def partial_counts(found: Iterator[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Distinct numbers of a task and how often each occurs; a number may come again in a later batch."""
    waiting, size = [], 0
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def fold() -> tuple[np.ndarray, np.ndarray]:
        new, times = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (keys[:0], n[:0])
        both, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
        return both, np.bincount(at, np.concatenate([n, times]), minlength=len(both)).astype(np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=names)

    for some in found:
        waiting.append(some)
        size += len(some)
        if size > SORT_IDS:
            keys, n = fold()
            waiting, size = [], 0
        if len(keys) > HELD_PAIRS:
            yield out()
            keys, n = keys[:0], n[:0]
    keys, n = fold()
    yield out()


def pair_counts(rows: DataFrame) -> DataFrame:
    """(key, n): the count of every pair (id before or START, id) of ``rows``; partial counts in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (_stored_ids(value) for batch in batches for value in batch.column("ids"))
        return partial_counts((np.append(START, ids[:-1]) * IDS + ids for ids in every), ["key", "n"])

    return rows.select("ids").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def counted_model(pairs: DataFrame) -> AttentionModel:
    """The model before its training, from the counts of all pairs (a written table)."""
    spark = pairs.sparkSession
    before, ids = F.expr(f"key div {IDS}"), F.col("key") % IDS

    def dense(rows: DataFrame, *shape: int, kind=np.float32) -> np.ndarray:
        got = rows.toPandas()  # at most one row for each place of ``shape``
        return _dense(got["at"].to_numpy(np.int64), got["n"].to_numpy(np.int64), shape, kind)

    total = lambda rows, at: rows.groupBy(at.alias("at")).agg(F.sum("n").alias("n"))
    counts = dense(total(pairs, ids), IDS, kind=np.int64)
    classes = spark.createDataFrame(pd.DataFrame({"id": np.arange(IDS + 1), "class": classes_of(counts)}))
    of = lambda at: pairs.join(F.broadcast(classes), at == F.col("id"))  # noqa: E731  # IDS + 1 rows
    inside = dense(total(of(before), F.col("class") * IDS + ids), CLASSES + 1, IDS)
    led = dense(total(of(ids), before * CLASSES + F.col("class")), IDS + 1, CLASSES)
    top = pairs.orderBy(F.desc("n"), "key").limit(COMMON_PAIRS).toPandas().sort_values("key")  # at most COMMON_PAIRS rows
    return AttentionModel.counted(counts, inside, led, top["key"].to_numpy(np.int64), top["n"].to_numpy(np.int64))


def windows_of(rows: DataFrame, share: float, groups: int) -> DataFrame:
    """(group, key, ids, n): ``share`` of the windows of ``rows``, dealt to ``groups`` (a partition each); n is 1.

    The choice hashes id, text and place only, so it does not depend on partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [np.zeros(0, np.uint64)], []
            for doc_id, value in zip(batch.column("doc_id"), batch.column("ids"), strict=True):
                raw = value.as_py()
                key = _mix(np.uint64(xxhash.xxh3_64_intdigest(f"{doc_id.as_py()} ".encode() + raw))
                           + np.arange(1, -(-len(raw) // (2 * WINDOW)) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                picked = np.flatnonzero(key.astype(np.float64) <= share * 2.0 ** 64)
                if len(picked):
                    ids = np.concatenate([[START], np.frombuffer(raw, "<u2"), np.full(WINDOW, PAD)]).astype("<u2")
                    found += [ids[at:at + WINDOW + 1].tobytes() for at in (picked * WINDOW).tolist()]
                    keys.append(key[picked])
            key = np.concatenate(keys)
            yield pa.RecordBatch.from_arrays([pa.array((key % np.uint64(groups)).astype(np.int32)), pa.array(key.view(np.int64)), pa.array(found, pa.binary())], names=["group", "key", "ids"])

    # a partition for each group, so the tasks that train have equal shares
    made = rows.select("doc_id", "ids").mapInArrow(run, "group int, key long, ids binary")
    return made.repartitionById(groups, F.col("group")).withColumn("n", F.lit(1).cast("long"))


def distinct_windows(key: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of ``key`` and ``ids`` in their order, and the sums of their ``n``."""
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])))
    return key[first], ids[first], np.add.reduceat(n[order], first)


def trained(model: AttentionModel, rows: DataFrame, total: int) -> AttentionModel:
    """``model`` with its attention layer trained on all windows of ``rows``, which have ``total`` of them."""
    if total:
        none = np.zeros(0, np.int64)  # training reads no pairs
        shared = rows.sparkSession.sparkContext.broadcast(replace(model, pairs=none, times=none))

        groups = -(-total // GROUP_WINDOWS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting, size = [], 0
            for batch in (b for b in batches if b.num_rows):
                ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"S{2 * (WINDOW + 1)}")
                waiting.append((batch.column("key").to_numpy(), ids, batch.column("n").to_numpy()))
                size += len(ids)
                if size > 4 * GROUP_WINDOWS:  # repeated rows: their windows are held once
                    waiting, size = [distinct_windows(*map(np.concatenate, zip(*waiting, strict=True)))], 0
            if not waiting:
                return
            key, ids, n = distinct_windows(*map(np.concatenate, zip(*waiting, strict=True)))
            group = key.view(np.uint64) % np.uint64(groups)
            for mine in (group == at for at in np.unique(group)):
                w = ids[mine].view("<u2").reshape(-1, WINDOW + 1).astype(np.int64)
                m = replace(shared.value, p={n: x.copy() for n, x in shared.value.p.items()})
                m.fit(np.where(w == PAD, -1, w), n[mine])
                yield pa.RecordBatch.from_arrays([pa.array([float(n[mine].sum())]), pa.array([np.concatenate([m.p[n].ravel() for n in sorted(m.p)]).astype(np.float64)])], names=["weight", "p"])

        each = windows_of(rows, 1.0, groups).select("key", "ids", "n").mapInArrow(run, "weight double, p array<double>")
        mean = (each.select("weight", F.posexplode("p").alias("at", "x")).groupBy("at")
                .agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x")).toPandas().sort_values("at")["x"].to_numpy())  # one row a weight
        at = 0
        for n in sorted(model.p):
            size = model.p[n].size
            model.p[n] = mean[at:at + size].reshape(model.p[n].shape)
            at += size
        shared.destroy()
    model.ready()
    return model


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, c): the count of every word of ``docs`` by its hash; partial counts in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return partial_counts((word_hashes(batch.column(0))[0] for batch in batches), ["h", "c"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def score_documents(docs: DataFrame, held_out: Column, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    ``held_out``: a condition on ``doc_id``; such rows are scored but nothing is learned from them.
    """
    spark = docs.sparkSession
    learn = docs.where(~held_out)
    tokens = written(token_rows(docs, held_out, tokenizer), "tokens", compression="zstd")
    known_rows = tokens.where("NOT held_out")
    windows, ends = known_rows.agg(F.coalesce(F.sum(F.expr(f"(n + {WINDOW - 1}) div {WINDOW}")), F.lit(0)), F.count("*")).first()  # each training text has one end token
    pairs = written(pair_counts(known_rows), "id-pairs")
    start = counted_model(pairs)
    others = pairs.count() > len(start.pairs)  # pairs that the model does not hold
    model = spark.sparkContext.broadcast(trained(start, known_rows, windows))
    counts = written(word_counts(learn), "word-counts")
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, unit = words + ends, words + ends + distinct + (ends > 0) + 1
    top = counts.orderBy(F.desc("c"), "h").limit(COMMON).toPandas().sort_values("h")  # at most COMMON rows
    common = spark.sparkContext.broadcast((top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, (keys, known) = model.value, common.value
        row = TaskContext.get().partitionId() << 40
        for batch in (b for b in batches if b.num_rows):
            waiting, held, scores, rare = [], 0, [], [] if others else None
            n_tokens, n_known, base, tails, times = [], [], [], [], []
            hashes, first = word_hashes(batch.column("text"))
            for mine, ids in zip(np.split(hashes, first[1:-1]), batch.column("ids"), strict=True):
                h, n = np.unique(mine, return_counts=True)
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                n_tokens.append(int(n.sum()) + 1)
                n_known.append(int(n[hit].sum()) + (ends > 0))
                base.append(float((n[hit] * np.log10((known[at[hit]] + 1) / unit)).sum()) + math.log10((ends + 1) / unit))
                tails.append(h[~hit])
                times.append(n[~hit])
                waiting.append(_stored_ids(ids))
                held += len(waiting[-1])
                if held > BATCH_IDS:
                    scores.append(m.score(waiting, rare))
                    waiting, held = [], 0
            if waiting:
                scores.append(m.score(waiting, rare))
            size = len(n_tokens)
            rest = [np.unique(k, return_counts=True) for k in rare] if others else [((), ())] * size
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + size)), batch.column("doc_id"), batch.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                pa.array(base, pa.float64()), pa.array(np.concatenate(scores) if scores else [], pa.float64()), pa.array(tails, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64())),
                pa.array([k for k, _ in rest], pa.list_(pa.int64())), pa.array([c for _, c in rest], pa.list_(pa.int64()))],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail", "times", "pair_tail", "pair_times"])
            row += size

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = written(tokens.select("doc_id", "held_out", "text", "ids").mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, tail array<long>, times array<long>, "
        "pair_tail array<long>, pair_times array<long>"), "scored")
    discard(tokens)
    # the words outside the common ones, through a join with all counts
    rest = rows.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("row", F.col("t.tail").alias("h"), F.col("t.times").alias("n"))
    looked = (rest.join(counts, "h", "left").groupBy("row")
              .agg(F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(unit)))).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("also")))
    scored = rows.drop("tail", "times", "pair_tail", "pair_times").join(looked, "row", "left")
    score = F.col("score")
    if others:  # the pairs outside the common ones, through a join with all counts

        def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """(key, gain): what the occurrences of a pair add to its log10 probability as an unseen one."""
            for batch in batches:
                key, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
                gain = np.log1p(n / model.value.prior(key // IDS, key % IDS).astype(np.float64)) / math.log(10)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(gain)], names=["key", "gain"])

        rest = rows.select("row", F.explode(F.arrays_zip("pair_tail", "pair_times")).alias("t")).select("row", F.col("t.pair_tail").alias("key"), F.col("t.pair_times").alias("n"))
        gained = rest.join(pairs.mapInArrow(gains, "key long, gain double"), "key").groupBy("row").agg(F.sum(F.col("n") * F.col("gain")).alias("gain"))
        scored = scored.join(gained, "row", "left")
        score = score + F.coalesce("gain", F.lit(0.0))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), score.alias("score"))
