"""Prefix trie of conversations by sorted shards and a splitter skeleton.

Turns are digests here (md5 of role and text), so texts are read once and never
shuffled. A conversation becomes rows of at most ``BAND`` turns: band b holds the
nodes of depths b * BAND to (b + 1) * BAND - 1 under a fingerprint of all turns
before, so a conversation that holds a third of all turns is many rows.

The rows are sorted by (path, conv_id) into range shards. Splitters come from a sample
and are cut to the shortest path that separates them from the one before; only
proper prefixes of a splitter's path can have members on both sides of it. The trie of those
prefixes, the skeleton, is broadcast. Each shard walks its sorted rows with a
stack and finishes every node outside the skeleton: members, children,
leaves and tokens saved below. For skeleton nodes it emits partial aggregates,
which are summed per node, then over the skeleton's subtrees. Equal conversations
are split by conv_id, so a conversation with very many copies spans shards; the ids that end in
such a node travel as texts of up to ``CHUNK`` ids and are hashed in order, one stream a node
(a hash of one list is sequential), never held whole.

Deep bands hang below nodes of the band above. What they add to the nodes above is summed
per conversation: the smallest member owns a node and all that follow on its
path, so a conversation saves the words of its turns above the first node it owns,
and has a leaf if it owns one.

Defined results: null roles and texts are empty; turns sort by turn (null first), those that
share a number by md5 of role and text; repeated rows are turns of their own; rows without conv_id
take no part; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.operators.ranking import ordinal_rank

from .common import BROADCAST_ROWS, written

#: Levels of a row, and ids of a text of ending conversations.
BAND, CHUNK = 256, 4096
#: A path is a head (4 bytes band, 16 bytes fingerprint of the turns before) and 16 bytes a turn.
HEAD, TURN = 20, 16
#: Shards per shuffle partition and sampled rows per shard.
SHARDS, SAMPLES = 2, 10
#: Fixed value: words of a text.
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256().hexdigest()

_DIGEST, _WORDS = "unhex(md5(concat(octet_length(role), ':', role, text)))", f"cast(regexp_count(text, r'{WORD}') AS bigint)"


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, turn, digest, words of every turn that has a conversation."""
    clean = turns.where("conv_id IS NOT NULL").selectExpr("cast(conv_id AS bigint) AS conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    return clean.selectExpr("conv_id", "turn", f"{_DIGEST} AS digest", f"{_WORDS} AS words")


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place (from 1) in the conversation, and (conv_id, first, n) per conversation."""
    flat = written(digests(turns).withColumn("row", F.monotonically_increasing_id()), "turns")
    ranked = ordinal_rank(flat, ["conv_id", "turn", "digest", "row"], "at")
    convs = written(ranked.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n")), "conversations")
    return ranked, convs


def rebuilt(turns: DataFrame, base: Column, shared: Column) -> DataFrame:
    """(conv_id, place, digest, words): the conversation ``base`` lends its first ``shared`` turns
    (columns of ``conv_id``; all it has, if fewer), then come the own turns after as many. Place 0 is a mark
    that every conversation has, also one without turns."""
    ranked, convs = numbered(turns)
    plan = convs.select("conv_id", "first", base.alias("base"), shared.cast("long").alias("h"))
    plan = plan.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("has")), "base", "left")
    plan = written(plan.select("conv_id", "first", "base", "h", F.least("h", F.coalesce("has", F.lit(0).cast("long"))).alias("k")), "rebuilt")
    most = plan.agg(F.max("k")).first()[0] or 0
    placed = ranked.join(plan.select("conv_id", "first", "h", "k"), "conv_id")
    placed = written(placed.select("conv_id", (F.col("at") - F.col("first") + 1).alias("place"), "h", "k", "digest", "words"), "places")
    lent = placed.where(F.col("place") <= most).select(F.col("conv_id").alias("base"), "place", "digest", "words")
    heads = plan.select("conv_id", "base", "k").where("k > 0").join(lent, "base").where("place <= k").select("conv_id", "place", "digest", "words")
    own = placed.where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("place"), "digest", "words")
    mark = convs.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return mark.unionByName(heads).unionByName(own)


def banded(turns: DataFrame, band: int) -> DataFrame:
    """Rows (conv_id, band, path, words, next): words of the turns at depths band * ``band`` and after, path of the turns that follow, next: head of the band below."""
    at = F.expr(f"place div {band}")
    # the first turn of a deep band also ends the path of the band above
    spots = turns.withColumn("band", F.explode(F.when((F.col("place") > 0) & (F.col("place") % band == 0), F.array(at - 1, at)).otherwise(F.array(at))))
    rows = spots.groupBy("conv_id", "band").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("t"))
    after = F.expr(f"filter(t, x -> x.place > band * {band})")
    rows = written(rows.select("conv_id", "band", F.array_join(F.transform(after, lambda x: F.hex(x["digest"])), "").alias("hex"),
                               F.expr(f"transform(filter(t, x -> x.place < (band + 1) * {band}), x -> x.words)").alias("words")), "bands")
    more = (F.col("band") > 0) | (F.length("hex") == 2 * TURN * band)
    # fingerprint of all bands before: xor of two placed 64-bit hashes of each, so that it is a running sum
    hashes = rows.where(more).select("conv_id", "band", F.xxhash64(F.lit(1), "band", "hex").alias("a"), F.xxhash64("band", "hex", F.lit(2)).alias("b"))
    order = Window.partitionBy("conv_id").orderBy("band")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    heads = hashes.select("conv_id", "band", _head(F.col("band"), *[F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")) for c in "ab"]).alias("head"))
    heads = heads.select("conv_id", "band", "head", F.lead("head").over(order).alias("next"))
    top = rows.where(~more).select("*", _head(*[F.lit(0).cast("long")] * 3).alias("head"), F.lit(None).cast("binary").alias("next"))
    return (top.unionByName(rows.where(more).join(heads, ["conv_id", "band"]))
            .select("conv_id", "band", F.concat("head", F.unhex("hex")).alias("path"), "words", "next"))


def _head(band: Column, a: Column, b: Column) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(band), 8, "0"), F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def splitters(rows: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` cuts (path, conv_id) of the sorted rows, from a sample of ``SAMPLES`` rows a shard."""
    total = rows.count()
    wanted = shards * SAMPLES
    part = rows if total <= wanted else rows.sample(min(1.0, 1.5 * wanted / total), seed=7).limit(2 * wanted)
    got = sorted((bytes(r.path), r.conv_id) for r in part.select("path", "conv_id").collect())  # 2 * shards * SAMPLES rows of a band at most
    cuts: list[tuple[bytes, int]] = []
    for i in range(SAMPLES, len(got), SAMPLES):
        (was, _), (path, conv) = got[i - SAMPLES], got[i]
        if path == was:
            cut = path, conv
        else:
            same = _common(was, path)
            cut = path[:HEAD] if same < 0 else path[:HEAD + (same + 1) * TURN], -(1 << 63)
        if not cuts or cut > cuts[-1]:
            cuts.append(cut)
    return cuts


def _common(a: bytes, b: bytes) -> int:
    """Common turns of two paths; -1 if their heads differ."""
    if a[:HEAD] != b[:HEAD]:
        return -1
    most = (min(len(a), len(b)) - HEAD) // TURN
    low = 0
    while low < most:  # the longest common prefix, by halves
        mid = (low + most + 1) // 2
        if a[:HEAD + mid * TURN] == b[:HEAD + mid * TURN]:
            low = mid
        else:
            most = mid - 1
    return low


def skeleton_of(cuts: list[tuple[bytes, int]]) -> frozenset[bytes]:
    """Paths of the nodes that may have members on both sides of a cut."""
    found: set[bytes] = set()
    for path, conv in cuts:
        last = len(path) if conv > -(1 << 63) else len(path) - TURN  # a cut among copies of one path has its own node on both sides
        found.update(path[:i] for i in range(HEAD, last + 1, TURN))
    return frozenset(found)


_EMITTED = ("kind string, path binary, above binary, below binary, depth long, conv_id long, parent_conv_id long, n long, children long, leaves long, saved long, "
            "words long, ends string, shard int, seq long")
_NAMES = [f.split()[0] for f in _EMITTED.split(", ")]


class _Node:
    """An open node: what its members in this shard have given so far."""

    __slots__ = ("path", "depth", "words", "first", "n", "children", "leaves", "saved", "hash", "ids", "held", "split", "next")

    def __init__(self, path, depth, words, split):
        self.path, self.depth, self.words, self.split = path, depth, words, split
        self.first, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.hash, self.ids, self.held, self.next = None, [], [], None


class _Walk:
    """Walks sorted rows of one shard after another; ``out`` gets finished rows."""

    def __init__(self, skeleton: frozenset[bytes], band: int):
        self.skeleton, self.band = skeleton, band
        self.stack: list[_Node] = []
        self.path, self.shard, self.seq, self.out = b"", -1, 0, []

    def emit(self, kind, path, above=None, below=None, depth=None, conv=None, parent=None, n=0, children=0, leaves=0, saved=0, words=0, ends=None):
        self.seq += 1
        self.out.append((kind, path, above, below, depth, conv, parent, n, children, leaves, saved, words, ends, self.shard, self.seq))

    def row(self, shard: int, path: bytes, conv: int, words: list[int], below: bytes | None, leaves: int, saved: int) -> None:
        if shard != self.shard:
            self.finish()
            self.shard = shard
        same = _common(self.path, path) if self.stack else -1
        while len(self.stack) > same + 1:
            self.close()
        first = int.from_bytes(path[:4], "big") * self.band
        for i in range(len(self.stack), (len(path) - HEAD) // TURN + 1):
            prefix = path[:HEAD + i * TURN]
            stub = i == self.band
            node = _Node(prefix, first + i, 0 if stub else words[i], prefix in self.skeleton)
            node.next = below if stub else None
            self.stack.append(node)
        self.path = path
        top = self.stack[-1]
        top.n += 1
        top.first = conv if top.first is None else min(top.first, conv)
        top.leaves += leaves
        top.saved += saved
        if top.next is None:
            if top.split:
                top.ids.append(conv)
                if len(top.ids) >= CHUNK:
                    self.chunk(top)
            elif top.hash is None:
                top.hash = hashlib.sha256(b"%d" % conv)
            else:
                top.hash.update(b",%d" % conv)

    def chunk(self, node: _Node) -> None:
        self.emit("ends", node.path, ends=",".join(map(str, node.ids)))
        node.ids = []

    def close(self) -> None:
        node = self.stack.pop()
        up = self.stack[-1] if self.stack else None
        if up is not None:
            up.n += node.n
            up.first = node.first if up.first is None else min(up.first, node.first)
        above = up.path if up else None
        if node.split:
            if node.ids:
                self.chunk(node)
            self.emit("part", node.path, above, node.next, node.depth, node.first, None, node.n, node.children, node.leaves, node.saved, node.words)
            return
        if node.next is None:
            node.leaves = node.leaves if node.children else 1
            node.saved += (node.n - 1) * node.words
            ends = node.hash.hexdigest() if node.hash else NO_ENDS
            done = ["node", None if up else node.path, None, None, node.depth, node.first, None, node.n, node.children, node.leaves, node.saved, 0, ends]
            for child in node.held:
                child[6] = node.first
                self.emit(*child)
        else:  # finished in the band below, which needs its parent's smallest member
            done = ["link", node.next, None, None, None, None, None]
        if up is None:
            self.emit(*done)
            return
        up.children += 1
        up.leaves += node.leaves
        up.saved += node.saved
        if up.split:  # its smallest member is known after the reduction
            done[2] = above
            self.emit(*done)
        else:
            up.held.append(done)

    def finish(self) -> None:
        while self.stack:
            self.close()
        self.path = b""


def _tries(rows: DataFrame, band: int) -> DataFrame:
    """All nodes of the bands' tries; ``rows``: conv_id, path, words, next, leaves, saved (of the bands below)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = splitters(rows, SHARDS * parts)
    skeleton = skeleton_of(cuts)
    shared = spark.sparkContext.broadcast((cuts, skeleton))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value[0]
        for b in batches:
            keys = zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist(), strict=True)
            yield b.append_column("shard", pa.array([bisect_right(cuts, k) for k in keys], pa.int32()))

    columns = rows.select("conv_id", "path", "words", "next", "leaves", "saved")
    sharded = columns.mapInArrow(dealt, "conv_id long, path binary, words array<long>, next binary, leaves long, saved long, shard int")
    sharded = sharded.repartition(parts, "shard").sortWithinPartitions("shard", "path", "conv_id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Walk(shared.value[1], band)
        for b in batches:
            for r in zip(*[b.column(c).to_pylist() for c in ("shard", "path", "conv_id", "words", "next", "leaves", "saved")], strict=True):
                w.row(*r)
                if len(w.out) >= CHUNK:
                    yield _batch(w.out)
                    w.out = []
        w.finish()
        if w.out:
            yield _batch(w.out)

    emitted = written(sharded.mapInArrow(walk, _EMITTED), "shards")
    top = written(_reduced(emitted), "skeleton")
    named = top.select(F.col("path").alias("above"), F.col("conv_id").alias("of"))
    named = F.broadcast(named) if len(skeleton) <= BROADCAST_ROWS else named
    columns = ["path", "above", "depth", "conv_id", "parent_conv_id", "n", "children", "leaves", "saved", "ends"]
    nodes = emitted.where("kind = 'node'").select(columns).unionByName(top.where("below IS NULL").select(columns))
    links = emitted.where("kind = 'link'").select("path", "above", "parent_conv_id").unionByName(
        top.where("below IS NOT NULL").select(F.col("below").alias("path"), "above", "parent_conv_id"))

    def resolved(part: DataFrame) -> DataFrame:
        return part.join(named, "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of")).drop("above", "of")

    deep_root = F.coalesce((F.octet_length("path") == HEAD) & (F.col("depth") > 0), F.lit(False))
    nodes = resolved(nodes)
    parents = resolved(links).groupBy("path").agg(F.min("parent_conv_id").alias("parent_conv_id"))
    roots = nodes.where(deep_root).drop("parent_conv_id").join(parents, "path", "left")
    return nodes.where(~deep_root).unionByName(roots).drop("path")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}
    kinds = [types[f.split()[1]] for f in _EMITTED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def _reduced(emitted: DataFrame) -> DataFrame:
    """Skeleton nodes from the shards' partial aggregates: per node, then over the subtrees."""
    parts = emitted.where("kind = 'part'").groupBy("path").agg(
        F.max("above").alias("above"), F.max("below").alias("below"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.max("words").alias("words"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            for path, ids in zip(b.column("path").to_pylist(), b.column("ends").to_pylist(), strict=True):
                if path != at:
                    if state is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], ["path", "ends"])
                    at, state = path, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], ["path", "ends"])

    chunks = emitted.where("kind = 'ends'").select("path", "shard", "seq", "ends").repartition("path").sortWithinPartitions("path", "shard", "seq")
    ends = chunks.select("path", "ends").mapInArrow(hashed, "path binary, ends string")
    below = parts.where("above IS NOT NULL").groupBy(F.col("above").alias("path")).agg(F.count("*").alias("more"))
    full = parts.join(below, "path", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    node = F.col("below").isNull()
    full = written(full.withColumn("leaves", F.col("leaves") + F.when(node & (F.col("children") == 0), 1).otherwise(0))
                   .withColumn("saved", F.col("saved") + F.when(node, (F.col("n") - 1) * F.col("words")).otherwise(0)), "skeleton-own")
    up = F.transform(F.sequence(F.lit(0), F.expr(f"cast((octet_length(path) - {HEAD}) div {TURN} AS int)")),
                     lambda i: F.substring(F.col("path"), F.lit(1), HEAD + i * TURN))
    sums = full.select(F.explode(up).alias("path"), "leaves", "saved").groupBy("path").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return (full.drop("leaves", "saved").join(sums, "path").join(ends, "path", "left")
            .select("path", "above", "below", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n", "children", "leaves", "saved",
                    F.coalesce("ends", F.lit(NO_ENDS)).alias("ends")))


def trie(turns: DataFrame, band: int = BAND) -> DataFrame:
    """depth, conv_id (smallest member), parent_conv_id, n, children, leaves, saved, ends: a row per node.

    ``turns``: (conv_id, place, digest, words) as :func:`rebuilt` gives them.
    """
    rows = written(banded(turns, band), "paths")
    none = F.lit(0).cast("long")
    deep = rows.where("band > 0")
    if deep.isEmpty():
        return _tries(rows.withColumns({"leaves": none, "saved": none}), band)
    owned = _tries(deep.withColumns({"leaves": none, "saved": none}), band).groupBy("conv_id").agg(
        F.min("depth").alias("owns"), F.max(F.when(F.col("children") == 0, F.col("depth"))).alias("leaf"))
    first = F.col("band") * band
    above = F.filter(F.col("words"), lambda w, i: F.col("owns").isNull() | (first + i < F.col("owns")))
    own = deep.join(owned, "conv_id", "left").select(
        "conv_id", "band", F.when((F.col("leaf") >= first) & (F.col("leaf") < first + band), 1).otherwise(0).cast("long").alias("leaves"),
        F.aggregate(above, F.lit(0).cast("long"), lambda a, w: a + w).alias("saved"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = own.select("conv_id", (F.col("band") - 1).alias("band"), F.sum("leaves").over(after).alias("leaves"), F.sum("saved").over(after).alias("saved"))
    return _tries(rows.join(sums, ["conv_id", "band"], "left").fillna(0, ["leaves", "saved"]), band)


def last_turns(nodes: DataFrame, turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with role and text of their last turn (null for the root)."""
    clean = conversations.where("conv_id IS NOT NULL").selectExpr("coalesce(role, '') AS role", "coalesce(text, '') AS text")
    texts = clean.selectExpr(f"{_DIGEST} AS digest", "role", "text").groupBy("digest").agg(F.min("role").alias("role"), F.min("text").alias("text"))
    places = turns.where("place > 0").select("conv_id", F.col("place").alias("depth"), "digest")
    return nodes.join(places, ["conv_id", "depth"], "left").join(texts, "digest", "left").drop("digest")
