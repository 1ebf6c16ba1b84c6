"""Deterministic hash sampling and arm assignment.

Membership and arms come from ``md5(id || ':' || salt)``: stable across runs,
partitionings and engines (the oracle computes the same md5), no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_md5(key: Column, salt: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(":" + salt)))


def hash_fraction_member(key: Column, salt: str, hex_threshold: str) -> Column:
    """True for keys whose md5 prefix is below ``hex_threshold`` (lowercase hex).

    The kept fraction is int(hex_threshold, 16) / 16 ** len(hex_threshold).
    """
    return F.substring(salted_md5(key, salt), 1, len(hex_threshold)) < F.lit(hex_threshold)


def assign_arm(key: Column, salt: str, first: str = "control", second: str = "variant") -> Column:
    """50/50 split on the first md5 hex digit."""
    return F.when(F.substring(salted_md5(key, salt), 1, 1) < F.lit("8"), F.lit(first)).otherwise(F.lit(second))


#: Digits of the hash that a histogram goes by, and rows that one task may sort in the end.
DIGITS, SMALL = 4, 20_000


def sample_exact_n(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same for any partitioning.

    Rows are ordered by a salted md5 of the key, then the key, and the first ``n`` kept. The cut is found by
    counting: rows per prefix of the hash (16 ** ``DIGITS`` counts) show which prefix holds the n-th row; if too many rows
    share it, their next digits are counted; only the last prefix's rows are sorted. The
    sample is then a filter on the table: nothing is sorted or written whole. Of rows that repeat the key at the
    cut, as many as are left stay.
    """
    h = salted_md5(F.col(key), seed)
    hashed = df.where(F.col(key).isNotNull()).select(h.alias("h"), F.col(key).alias("k"))
    nulls = df.where(F.col(key).isNull())  # no hash: they come first, as null does in the order
    have = hashed.agg(F.count(F.lit(1))).first()[0]
    first = nulls.count()
    if n >= have + first:
        return df
    if n <= first:
        return nulls.limit(n)
    prefix, left = "", n - first  # the n-th row is the left-th under the prefix
    while True:
        part = hashed.where(F.col("h").startswith(prefix))
        end = len(prefix) + DIGITS
        if end > 32:
            break
        counts = part.groupBy(F.substring("h", 1, end).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()  # at most 16 ** DIGITS
        for r in counts:
            if left <= r.n:
                prefix, held = r.p, r.n
                break
            left -= r.n
        if held <= SMALL:
            part = hashed.where(F.col("h").startswith(prefix))
            break
    # equal keys fall together: how many of each are needed is counted, not sorted
    keys = part.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "k").collect()  # SMALL keys, or those of one whole hash
    for r in keys:
        cut, held = r, r.n
        if left <= r.n:
            break
        left -= r.n
    kind = df.schema[key].dataType
    at = F.lit(cut.k).cast(kind)
    below = (h < cut.h) | ((h == cut.h) & (F.col(key) < at))
    if left == held:
        return df.where(F.col(key).isNull() | below | ((h == cut.h) & (F.col(key) == at)))
    return df.where(F.col(key).isNull() | below).unionAll(df.where((h == cut.h) & (F.col(key) == at)).limit(left))
