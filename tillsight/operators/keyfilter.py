"""Bloom filters of keys, built by aggregation and tested in the scan.

A filter is an array of 64-bit words, made by ``bit_or`` per word (partial aggregates
first) and used as a scalar subquery, so a row is tested where it is read. Its size is bounded
by ``MOST_BITS`` whatever the number of keys: a fuller filter only says "maybe" more often. "No" is always
right, "maybe" has to be checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, and the bounds of a filter (2 MB at most).
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 10, 1 << 24


def bits_for(keys: int) -> int:
    """A power of two, ``BITS_PER_KEY`` for each key within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (keys * BITS_PER_KEY - 1).bit_length() if keys else LEAST_BITS))


def _spots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) for i in range(3)]


def key_filter(keys: DataFrame, key: str, bits: int) -> Column:
    """The filter of all non-null ``key`` as an array of words (a scalar subquery)."""
    spots = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_spots(F.col(key), bits))).alias("at"))
    words = spots.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS int))")).alias("bits"))
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    # one row of bits / 64 words
    return every.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("w")).select("w.bits").scalar()


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """False if ``key`` is certainly not in the filter."""
    found = F.lit(True)
    for at in _spots(key, bits):
        word = F.element_at(words, F.expr("1").cast("int") + F.floor(at / 64).cast("int"))
        found = found & (F.getbit(word, (at % 64).cast("int")) == 1)
    return found
