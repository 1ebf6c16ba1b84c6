"""Benchmark decontamination: a prefix-filtered set join over word shingles.

A window is ``window`` consecutive words of a benchmark item (an item of fewer
words is one window). A document is hit wherever a window occurs in it whole.
A window can occur only where all its shingles occur, so one of them, its
prefix, is enough to look for it: with containment 1 the necessary prefix has
one token. Shingles are ordered by rarity in the documents, and the rarest one
of each window is its prefix. The offset of the prefix gives the only place
where the window can start (positional bound), which must leave room for the
whole window (length bound). There the words are compared one by one.

All of it is DataFrame functions. Words are runs of ASCII digits, letters
(A-Z lower-cased) and non-ASCII characters.

Defined results: null and empty texts have no words and no hits; items with a
null id, null text or no words take no part; items that repeat an id count as
one item; repeated documents each get their own row, as do rows with a null id;
an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z are lower-cased.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 3
#: The token of place -1; a shingle with the same hash would only add a place to compare.
MARK = -1
#: Distinct benchmark shingles (a hash of 8 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_SHINGLES = 1 << 20


def words_of(text: Column) -> Column:
    """Words of a text, each in its own case."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD_ANY_CASE), F.lit(0)), F.array().cast("array<string>"))


def _shingle(words: str, at: str, length: int) -> Column:
    """A hash that ignores case. ``lower`` folds more than A-Z, which only adds places to compare."""
    return F.expr(f"xxhash64({length}, " + ", ".join(f"lower(get({words}, {at} + {j}))" for j in range(length)) + ")")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, phrase, n): the windows of every item, their words joined by blanks."""
    return (items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), words_of(ascii_lower(F.col("text"))).alias("w"))
            .where("size(w) > 0").withColumn("n", F.least(F.lit(window), F.size("w")))
            .select("item_id", "n", "w", F.expr("explode(sequence(0, size(w) - n))").alias("i"))
            .select("item_id", F.expr("concat_ws(' ', slice(w, i + 1, n))").alias("phrase"), "n").distinct())


def _text_md5() -> Column:
    return F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def _places(text: DataFrame, lengths: list[int], first: int) -> DataFrame:
    """doc_id, text_md5, w, i, tok: every place of every text from ``first`` on, with the shingles of ``lengths`` there."""
    # No filter on w, and an outer explode: either would be pushed below the words and find them twice.
    at = text.select("doc_id", "text_md5", "w", F.explode_outer(F.expr(f"sequence({first}, greatest(size(w) - {lengths[0]}, {first}))")).alias("i"))
    toks = [F.when((F.col("i") >= 0) & (F.col("i") + g <= F.size("w")), _shingle("w", "i", g)) for g in lengths]
    mark = F.lit(MARK).cast("long")
    if len(toks) == 1:
        return at.withColumn("tok", F.when(F.col("i") < 0, mark).otherwise(toks[0]))
    return at.select("*", F.explode_outer(F.when(F.col("i") < 0, F.array(mark)).otherwise(F.array(*toks))).alias("tok"))


def _prefixes(found: DataFrame, parts: DataFrame, windows: DataFrame) -> DataFrame:
    """wid, tok, offset, n, phrase: the rarest shingle of each window; a window with one that never occurs cannot occur."""
    rarity = found.groupBy("tok").agg(F.count("*").alias("df"))
    prefix = (parts.join(rarity, "tok", "left").groupBy("wid")
              .agg(F.min(F.struct("df", "tok", "offset")).alias("p"), F.max(F.col("df").isNull()).alias("never")).where(~F.col("never"))
              .select("wid", "p.tok", "p.offset").join(windows, "wid"))
    return written(prefix.select("wid", "tok", "offset", "n", "phrase"), "prefixes")


def document_hits(docs: DataFrame, items: DataFrame, window: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Occurrences of windows: (doc_id, text_md5, start, n, wid); (wid, item_id); and
    (doc_id, text_md5, n_words) for every row of ``docs``."""
    every = item_windows(items, window)
    windows = written(every.select("phrase", "n").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    owners = written(every.join(windows, ["phrase", "n"]).select("wid", "item_id"), "window-items")
    parts = windows.withColumn("w", F.split("phrase", " ")).withColumn("g", F.least(F.lit(SHINGLE), F.col("n")))
    parts = parts.select("wid", "g", "w", F.expr("explode(sequence(0, n - g))").alias("offset"))
    parts = written(parts.select("wid", "offset", "g", F.coalesce(*(F.when(F.col("g") == g, _shingle("w", "offset", g)) for g in range(1, SHINGLE + 1))).alias("tok")), "window-shingles")
    mark = F.lit(MARK).cast("long").alias("tok")
    wanted = written(parts.select("tok").union(docs.sparkSession.range(1).select(mark)).distinct(), "shingles")
    lengths = sorted(r["g"] for r in parts.select("g").distinct().collect()) or [SHINGLE]  # at most SHINGLE rows

    text = docs.select("doc_id", _text_md5().alias("text_md5"), words_of(F.col("text")).alias("w"))
    around = f"concat_ws(' ', slice(w, low + 1, {2 * window}))"
    if wanted.count() <= BROADCAST_SHINGLES:
        # Place -1 stands for the row itself and is found through a token of its own.
        at = _places(text, lengths, -1).join(F.broadcast(wanted), "tok").withColumn("low", F.greatest(F.col("i") - (window - 1), F.lit(0)))
        found = written(at.select("doc_id", "text_md5", "tok", "i", "low", F.size("w").alias("n_words"), F.when(F.col("i") >= 0, F.expr(around)).alias("around")), "shingles-found")
        rows = found.where("i < 0").select("doc_id", "text_md5", F.col("n_words").cast("long").alias("n_words"))
        found = found.where("i >= 0")
        prefix = _prefixes(found, parts, windows)
    else:
        # Only ids and places are shuffled; the words around those of the prefixes are fetched afterwards, once a text.
        rows = written(text.select("doc_id", "text_md5", F.size("w").cast("long").alias("n_words")), "rows")
        found = written(_places(text, lengths, 0).select("doc_id", "text_md5", "tok", "i").join(wanted, "tok"), "shingles-found")
        prefix = _prefixes(found, parts, windows)
        near = (found.join(prefix.select("tok").distinct(), "tok").groupBy(F.col("doc_id").alias("id"), F.col("text_md5").alias("md5"))
                .agg(F.collect_set(F.struct("i", "tok")).alias("places")))  # at most one for each word of a text and shingle length
        whole = docs.select("doc_id", _text_md5().alias("text_md5"), "text")
        whole = whole.join(near, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_md5") == F.col("md5"))).select("doc_id", "text_md5", "places", words_of(F.col("text")).alias("w"))
        low = f"greatest(p.i - {window - 1}, 0)"
        found = whole.select("doc_id", "text_md5", F.size("w").alias("n_words"), F.expr(
            f"inline_outer(transform(places, p -> named_struct('i', p.i, 'tok', p.tok, 'low', {low}, 'around', {around.replace('low', low)})))"))
    hits = (found.join(prefix, "tok").withColumn("start", F.col("i") - F.col("offset"))
            .where("start >= 0 AND start + n <= n_words")
            .where(ascii_lower(F.expr("concat_ws(' ', slice(split(around, ' '), start - low + 1, n))")) == F.col("phrase"))
            .select("doc_id", "text_md5", "start", "n", "wid").distinct())
    return written(hits, "hits"), owners, rows


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, text_md5, n_words, n_hit, items (sorted as strings) and hit spans for every row of ``docs``."""
    hits, owners, rows = document_hits(docs, items, window)
    # a row's hit words: what each occurrence adds beyond the furthest end before it
    before = "max(start + n) OVER (PARTITION BY doc_id, text_md5 ORDER BY start, n, wid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    spans = (hits.withColumn("reach", F.expr(before))
             .withColumn("gain", F.expr("greatest(0, start + n - greatest(start, coalesce(reach, start)))"))
             .groupBy("doc_id", "text_md5").agg(F.sum("gain").alias("n_hit"), F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans")))
    held = (hits.select("doc_id", "text_md5", "wid").distinct().join(owners, "wid").select("doc_id", "text_md5", "item_id").distinct()
            .groupBy("doc_id", "text_md5").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    rows = rows.withColumnsRenamed({"doc_id": "id", "text_md5": "md5"})
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("md5") == F.col("text_md5"))
    out = rows.join(spans, same, "left").drop("doc_id", "text_md5").join(held, same, "left")
    return out.select(F.col("id").alias("doc_id"), F.col("md5").alias("text_md5"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")
