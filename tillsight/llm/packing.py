"""Hierarchical multi-length packing of documents into training sequences.

Every task packs the documents of its own partition, so nothing is shuffled:

1. A document becomes its token ids and an end id. What fills whole windows of
   the largest size is cut off at once; the remainder is routed to the smallest
   tier (context size) that holds it.
2. Each tier is packed from its longest document down. A window's gap is filled
   with the longest waiting document of any shorter tier that fits, again and
   again; what is then left is filled by a piece cut from the longest waiting
   document, whose rest is routed anew. So a window is closed only when it is full.
3. Closed windows of a tier are dealt to step groups in a snake over their
   attention cost (sum of squared piece lengths), which balances the groups.

Only the last windows of a partition may stay short. They are cut to whole
tiers, and at most one window in a partition is padded.

Memory: at most ``CHUNK_DOCS`` waiting documents, each under the largest size, and
``GROUP * DEAL`` closed windows a tier. A lost task is simply run again.

Defined results: null text is empty text (its end id alone); repeated rows and
null ids are packed as documents of their own.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import byte_level

TIERS = (2048, 1024, 512, 256)
CHUNK_DOCS = 1024
#: Sequences of a step group, and the groups between which closed windows are dealt.
GROUP, DEAL = 16, 16
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Packer:
    """Packs pieces (length, order, doc_id, start, ids, doc_tokens) into full windows."""

    def __init__(self, emit: Callable[[int, list], None], tiers: tuple[int, ...] = TIERS) -> None:
        self.emit, self.tiers, self.order = emit, tiers, 0
        self.wait: list[tuple] = []  # sorted by length

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, at, top = len(ids) // 4, 0, self.tiers[0]
        while total - at >= top:
            self.emit(top, [(doc_id, at, ids[at * 4:(at + top) * 4], total)])
            at += top
        if at < total:
            self._route(doc_id, at, ids[at * 4:], total)
        if len(self.wait) >= CHUNK_DOCS:
            self._pack(CHUNK_DOCS // 4)

    def _route(self, doc_id: int | None, start: int, ids: bytes, total: int) -> None:
        self.order += 1
        insort(self.wait, (len(ids) // 4, self.order, doc_id, start, ids, total), key=lambda p: p[:2])

    def _pack(self, keep: int) -> None:
        """Close windows, longest document first, until ``keep`` documents wait."""
        while len(self.wait) > keep:
            n = self.wait[-1][0]
            tier = min(t for t in self.tiers if t >= n)
            if not self._close(tier):
                break

    def _close(self, tier: int) -> bool:
        window, gap = [], tier
        while gap and self.wait:
            at = bisect_right(self.wait, gap, key=lambda p: p[0])
            if at:
                n, _, doc_id, start, ids, total = self.wait.pop(at - 1)
                window.append((doc_id, start, ids, total))
                gap -= n
            else:  # nothing fits whole: a piece of the longest
                n, _, doc_id, start, ids, total = self.wait.pop()
                window.append((doc_id, start, ids[:gap * 4], total))
                self._route(doc_id, start + gap, ids[gap * 4:], total)
                gap = 0
        if gap:
            for doc_id, start, ids, total in window:
                self._route(doc_id, start, ids, total)
            return False
        self.emit(tier, window)
        return True

    def finish(self) -> None:
        self._pack(0)
        left = sum(p[0] for p in self.wait)
        for tier in self.tiers:
            while left >= tier and self._close(tier):
                left -= tier
        if self.wait:  # less than the smallest tier: one padded window
            self.emit(self.tiers[0], [(d, s, ids, total) for _, _, d, s, ids, total in self.wait])
            self.wait = []


class Dealer:
    """Numbers closed windows and deals them to balanced step groups."""

    def __init__(self, base: int) -> None:
        self.base, self.sequence, self.group, self.full, self.out = base, 0, 0, defaultdict(list), []

    def take(self, tier: int, window: list) -> None:
        waiting = self.full[tier]
        waiting.append(window)
        if len(waiting) == GROUP * DEAL:
            self.deal(tier)

    def deal(self, tier: int) -> None:
        waiting = sorted(self.full.pop(tier, []), key=lambda w: -sum(len(p[2]) ** 2 for p in w))
        groups = -(-len(waiting) // GROUP)
        for i, window in enumerate(waiting):
            lap, at = divmod(i, groups)
            group = self.base + self.group + (at if lap % 2 == 0 else groups - 1 - at)
            offset = 0
            for doc_id, start, ids, total in window:
                n = len(ids) // 4
                self.out.append((doc_id, start, n, ids, total, self.base + self.sequence, offset, tier, group))
                offset += n
            self.sequence += 1
        self.group += groups

    def drain(self) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        cols = list(zip(*self.out, strict=True)) or [()] * len(kinds)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 1, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row for each piece, with its ids (little-endian 32-bit), place and step group.

    ``tokenizer``: a file, or the name of a public tokenizer, of the tokenizers library.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level(tokenizer).ids
        dealer = Dealer(TaskContext.get().partitionId() << 40)
        packer = Packer(dealer.take, tiers)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, encode(text.as_py() or "") + end)
                if len(dealer.out) >= 2000:
                    yield dealer.drain()
        packer.finish()
        for tier in tiers:
            dealer.deal(tier)
        yield dealer.drain()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
