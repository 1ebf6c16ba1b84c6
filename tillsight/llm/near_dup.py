"""MinHash near-duplicate detection by a multi-index Hamming join.

1. Every text becomes the set of its distinct word shingles (64-bit hashes) and
   a signature of ``slots`` MinHash values of 16 bits. Texts of one set form a
   class with a key of its own; the row of smallest id and text md5 stands for it.
2. A signature is cut into ``CHUNKS`` chunks of ``width`` slots. If two
   signatures differ in at most ``CHUNKS * (ERRORS + 1) - 1`` slots, then by
   pigeonhole one chunk differs in at most ``ERRORS`` slots. Each chunk is
   enumerated with every choice of ``ERRORS`` slots left out, so such a pair meets
   in a bucket: no pair under that signature distance is lost. ``width`` is the
   largest for which a pair at the threshold is beyond the distance with
   probability under ``MISS``.
3. Buckets never emit all their pairs. The member that shares most buckets is
   the bucket's hub; every member is compared with it on full sets and linked
   classes are merged. What is left are pairs in one bucket whose classes are
   still in different components. For hub h, sets x and y share at most
   ``min(|x & h|, |y & h|) + min(e_x, e_y)`` shingles, e_x being those of x outside
   h that another member of the hub has as well. The remaining pairs are listed
   by a bucket join that drops a pair when the sizes, this bound or the signature
   distance rule it out, and are confirmed on full sets.
4. Components of the confirmed links of classes give each document its smallest reachable id.

Joins are merged, never broadcast: a small side would pass through the driver, and there are dozens of them. Only
the id filter of fixed size is broadcast.

A pair is linked when ``100 * |A & B| >= percent * |A | B|`` on full sets.

Defined results: null or empty texts, and texts without a word, have no shingles
and link with nothing; a text of fewer words than a shingle is one shingle;
rows with a null id are never linked (null component, kept); rows that repeat an
id get the component of their own text's class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filtered, id_filter, id_type, written
from .components import connected_components

CHUNKS, ERRORS, MISS = 10, 1, 1e-4
#: Members of a hub that one task compares with others; those of larger hubs are dealt out in blocks.
BLOCK = 2048
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def chunk_width(percent: int) -> int:
    """Slots of a chunk: the largest width whose misses at the threshold stay under ``MISS``."""
    limit, differ = CHUNKS * (ERRORS + 1) - 1, 1 - percent / 100
    for width in range(8, ERRORS + 1, -1):
        n = CHUNKS * width
        kept = sum(math.comb(n, k) * differ ** k * (1 - differ) ** (n - k) for k in range(min(limit, n) + 1))
        if 1 - kept < MISS:
            return width
    return ERRORS + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    Words are maximal runs of bytes outside ASCII white space, A-Z lower-cased;
    ``bytes.split`` and ``bytes.lower`` do exactly that.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j]
    return np.unique(_mix(out))


def _multipliers(slots: int) -> np.ndarray:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 63, slots, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """16 bits of the minimum of each of the hash orders ``h * mult`` (mod 2^64)."""
    least = np.full(len(mult), _MASK)
    for at in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[at:at + 4096, None] * mult).min(0), out=least)
    return (_mix(least) >> np.uint64(48)).astype(np.uint16)


def text_key(text: Column) -> Column:
    """md5 of a text; empty for null, so that it differs from the empty text."""
    return F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit(""))


def sketch(docs: DataFrame, words: int, slots: int) -> DataFrame:
    """doc_id, text_md5, n_shingles, digest of the set, and signature (16-bit slots packed in longs)."""
    longs = -(-slots // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = _multipliers(slots)
        for batch in batches:
            n, digests, sigs = [], [], np.zeros((len(batch), longs * 4), np.uint16)
            for row, text in enumerate(batch.column("text")):
                s = shingles(text.as_py(), words)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(s):
                    sigs[row, :slots] = signature(s, mult)
            flat = pa.array(sigs.view(np.int64).ravel())
            packed = pa.ListArray.from_arrays(pa.array(np.arange(0, longs * (len(batch) + 1), longs, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_md5"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), packed],
                                             names=["doc_id", "text_md5", "n_shingles", "digest", "sig"])

    ids = id_type(docs)
    return (docs.select(F.col("doc_id").cast(ids).alias("doc_id"), F.col("text").cast("string").alias("text"), text_key(F.col("text")).alias("text_md5"))
            .mapInArrow(run, f"doc_id {ids}, text_md5 string, n_shingles long, digest binary, sig array<long>"))


def bucket_keys(reps: DataFrame, width: int) -> DataFrame:
    """(key, rep): one row for each chunk and slot left out of it."""
    slots = CHUNKS * width
    left = np.array([[c * width + j for j in range(width) if j != out] for c in range(CHUNKS) for out in range(width)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            sig = batch.column("sig").flatten().to_numpy().view(np.uint16).reshape(len(batch), -1)[:, :slots].astype(np.uint64)
            key = np.broadcast_to(np.arange(1, len(left) + 1, dtype=np.uint64), (len(sig), len(left)))
            for j in range(width - 1):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, left[:, j]])
            rep = np.repeat(batch.column("rep").to_numpy(), len(left))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).ravel()), pa.array(rep)], names=["key", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "key long, rep long")


def _distance(a: str, b: str, slots: int) -> Column:
    """Slots in which two packed signatures differ."""
    total = F.lit(0)
    lanes = F.lit(0x0001000100010001)
    for i in range(-(-slots // 4)):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for shift in (8, 4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(lanes))
    return total


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def overlaps(pairs: DataFrame, docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, inter, extra, linked) of pairs of classes, from the full sets: the
    size of the common part, the hashes of a that b lacks, and whether the pair reaches the threshold.

    ``pairs`` has a, b and their digests da, db; ``reps`` has the doc_id and text_md5 of the
    row that stands for each class (rep). The text of ``a`` travels to the
    pair by ``a``, then the pair to the text of ``b``; ``b`` may be a hub with very many
    partners, so its rows are salted by the number of its pairs.
    """
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct().join(reps.select("rep", "doc_id", "text_md5").hint("merge"), "rep")
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast(id_type(docs)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = filtered(texts, "doc_id", id_filter(wanted, "doc_id")).withColumn("text_md5", text_key(F.col("text"))).dropDuplicates(["doc_id", "text_md5"])
    texts = texts.join(wanted.hint("merge"), ["doc_id", "text_md5"]).select(F.col("rep").alias("id"), "text")
    hubs = (pairs.groupBy("b").agg(F.count("*").alias("n")).withColumn("salts", F.ceil(F.col("n") / 256).cast("int")))
    right = (texts.withColumnRenamed("id", "b").withColumnRenamed("text", "tb").join(hubs.select("b", "salts").hint("merge"), "b")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts"))
    left = (pairs.join(hubs.select("b", "salts").hint("merge"), "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")).drop("salts")
            .join(texts.withColumnRenamed("id", "a").withColumnRenamed("text", "ta").hint("merge"), "a"))
    both = left.join(right.hint("merge"), ["b", "salt"]).select("a", "b", "da", "db", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in batches:
            rows = []
            for a, b, da, db, ta, tb in zip(*(batch.column(i) for i in range(6)), strict=True):
                key = (b.as_py(), db.as_py(), len(tb.as_py()))
                if key != last:  # rows of one hub follow one another
                    hub, last = shingles(tb.as_py(), words), key
                    good = xxhash.xxh3_128_digest(hub.tobytes()) == key[1]
                if not good:  # not the text that was sketched
                    raise RuntimeError(f"the text of class {key[0]} changed")
                s = shingles(ta.as_py(), words)
                if xxhash.xxh3_128_digest(s.tobytes()) != da.as_py():
                    raise RuntimeError(f"the text of class {a.as_py()} changed")
                extra = s[hub[np.minimum(np.searchsorted(hub, s), len(hub) - 1)] != s]
                inter = len(s) - len(extra)
                rows.append((a.as_py(), key[0], inter, extra.view(np.int64), 100 * inter >= percent * (len(hub) + len(extra))))
            cols = list(zip(*rows, strict=True)) or [(), (), (), (), ()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.bool_())],
                                             names=["a", "b", "inter", "extra", "linked"])

    return both.mapInArrow(run, "a long, b long, inter long, extra array<long>, linked boolean")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    return grouped(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")


def grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_md5, n_shingles, component_id, component_md5, kept for every row of ``docs``.

    component_id and component_md5 are the id and text md5 of the row that stands for the component,
    the one of the smallest id and, of its texts there, the smallest md5.
    """
    width = chunk_width(percent)
    slots, limit = CHUNKS * width, CHUNKS * (ERRORS + 1) - 1
    rows = written(sketch(docs, words, slots), "sketch")
    classes = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_md5")).alias("least"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    # the key of a class: an id may have several texts
    reps = written(classes.select(F.monotonically_increasing_id().alias("rep"), "least.doc_id", "least.text_md5", "digest", "n", "sig"), "classes")

    keys = bucket_keys(reps, width)
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(keys.join(shared.hint("merge"), "key"), "members")
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight")).join(reps.select("rep", F.col("doc_id").alias("id")).hint("merge"), "rep")
    weighed = members.join(weight.hint("merge"), "rep")
    hubs = weighed.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("less"), "id", "rep"))["rep"].alias("hub"))
    hubbed = written(members.join(hubs.hint("merge"), "key").select("key", "rep", "hub"), "hubs")

    info = reps.select("rep", "n", "sig", "digest")

    def side(at: str) -> DataFrame:
        return info.select(F.col("rep").alias(at), F.col("n").alias(f"n{at}"), F.col("sig").alias(f"s{at}"), F.col("digest").alias(f"d{at}")).hint("merge")

    def digest(at: str) -> DataFrame:
        return side(at).select(at, f"d{at}").hint("merge")

    first = (hubbed.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
             .join(side("a"), "a").join(side("b"), "b").where(_sizes_allow("na", "nb", percent) & (_distance("sa", "sb", slots) <= limit)))
    first = written(first.select("a", "b", "da", "db"), "hub-pairs")
    known = written(overlaps(first, docs, reps, words, percent), "hub-overlaps")
    merged = written(connected_components(known.where("linked")), "merged")

    # members of buckets that are still in several components, once for each hub; two members of one bucket share its hub
    now = (hubbed.join(merged.withColumnRenamed("id", "rep").hint("merge"), "rep", "left")
           .select("key", "rep", "hub", F.coalesce("component", "rep").alias("component")))
    mixed = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    rest = written(now.join(mixed.hint("merge"), "key").where("rep <> hub").groupBy("rep", "hub").agg(F.first("component").alias("component")), "rest")
    # every remaining member's overlap with its hub, also where the signatures are too far apart
    pairs = rest.select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    lacking = written(pairs.join(known.select("a", "b").hint("merge"), ["a", "b"], "left_anti").join(digest("a"), "a").join(digest("b"), "b")
                      .select("a", "b", "da", "db"), "lacking")
    apart = written(overlaps(lacking, docs, reps, words, percent), "apart")
    seen = written(known.union(apart).join(pairs.hint("merge"), ["a", "b"], "left_semi").select("a", "b", "inter", "extra"), "seen")
    # what a member has beyond its hub can only add to a pair's overlap where another member of the hub has it too
    extras = seen.select("a", "b", F.explode("extra").alias("s"))
    common = extras.groupBy("b", "s").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    spare = extras.join(common.hint("merge"), ["b", "s"]).groupBy("a", "b").agg(F.count("*").alias("spare"))
    spare = seen.select("a", "b", "inter").join(spare.hint("merge"), ["a", "b"], "left").select(
        F.col("a").alias("rep"), F.col("b").alias("hub"), "inter", F.coalesce("spare", F.lit(0)).alias("spare"))
    home = merged.select(F.col("id").alias("hub"), F.col("component").alias("home"))
    sizes = rest.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rest = written(rest.join(spare.hint("merge"), ["rep", "hub"]).join(info.drop("digest").hint("merge"), "rep").join(sizes.hint("merge"), "hub").join(home.hint("merge"), "hub", "left").select(
        "hub", "rep", "component", "inter", "spare", "n", "sig", "blocks",
        (F.col("component") == F.coalesce("home", "hub")).alias("at_home")), "members-left")

    def reachable(inter: str, n: str, other: str) -> str:
        """Whether an overlap of at most ``inter`` can link sets of these sizes."""
        return f"100 * ({inter}) >= {percent} * (({n}) + greatest({other}, {inter}) - ({inter}))"

    # pairs with at least one side outside the hub's component; that side must be able to reach the threshold at all
    left = (rest.where(~F.col("at_home") & F.expr(reachable("inter + spare", "n", f"{percent} * n div 100")))
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("blocks", "at_home"))
    right = rest.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    most = "least(l.inter, r.inter) + least(l.spare, r.spare)"
    both = left.alias("l").join(right.hint("merge").alias("r"), [F.col("l.hub") == F.col("r.hub"), F.col("l.block") == F.col("r.block"),
                                                   F.expr("r.at_home OR l.rep < r.rep"), F.col("l.component") != F.col("r.component"),
                                                   _sizes_allow("l.n", "r.n", percent), F.expr(reachable(most, "l.n", "r.n")),
                                                   _distance("l.sig", "r.sig", slots) <= limit])
    second = both.select(F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")).distinct()
    tested = known.select("a", "b").union(apart.select("a", "b"))
    tested = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = second.join(tested.hint("merge"), ["a", "b"], "left_anti").join(digest("a"), "a").join(digest("b"), "b")
    second = written(second.select("a", "b", "da", "db"), "rest-pairs")
    more = overlaps(second, docs, reps, words, percent).where("linked").select("a", "b").union(apart.where("linked").select("a", "b"))

    # the components of the first round are the nodes of the second: only what it adds is contracted
    place = reps.join(merged.withColumnRenamed("id", "rep").hint("merge"), "rep", "left").select(
        "rep", "digest", F.coalesce("component", "rep").alias("component"), F.struct("doc_id", "text_md5").alias("least"))
    at = place.select("rep", "component")
    added = written(more.join(at.select(F.col("rep").alias("a"), F.col("component").alias("ca")).hint("merge"), "a")
                    .join(at.select(F.col("rep").alias("b"), F.col("component").alias("cb")).hint("merge"), "b")
                    .where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "added-links")
    named = place.drop("rep")
    if not added.isEmpty():
        final = connected_components(added).select(F.col("id").alias("component"), F.col("component").alias("final"))
        named = named.join(final.hint("merge"), "component", "left").withColumn("component", F.coalesce("final", "component")).drop("final")
    names = named.groupBy("component").agg(F.min("least").alias("least"))
    named = named.drop("least").join(names.hint("merge"), "component").select("digest", "least")
    alone = F.col("n_shingles").eqNullSafe(0)

    def of(own: str) -> Column:
        return F.when(alone, F.col(own)).when(F.col("doc_id").isNull(), None).otherwise(F.col(f"least.{own}"))

    return (rows.join(named.hint("merge"), "digest", "left")
            .select("doc_id", "text_md5", "n_shingles", of("doc_id").alias("component_id"), of("text_md5").alias("component_md5"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
