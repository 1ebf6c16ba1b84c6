"""Rows at given positions of an order, without sorting the table.

A quantile or a cut needs a few rows of an order, not the whole order. Each round takes
splitters from a small sample of the span that holds a position, counts the rows
between them in one pass, and goes on with the range that the position falls into, until the range
is small enough to be sorted in one task or holds a single key. Splitters only decide how fast it gets narrow;
counts are exact, so the result is. A value that most rows share is split by the later keys
(``frequency, customer_id``: by ranges of ids).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Rows that one task may sort in the end, and ranges of a round.
SMALL, RANGES = 20_000, 32


def key_literal(key: Row, schema) -> Column:
    """A key as a literal struct of the keys' types."""
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, key, strict=True)])


def order_statistics(df: DataFrame, keys: Sequence[str], positions: Sequence[int]) -> dict[int, Row]:
    """The keys at 1-based ``positions`` of the ascending order of ``keys`` (null first). Positions outside the table are left out."""
    rows = df.select(F.struct(*keys).alias("k"))
    schema = rows.schema["k"].dataType
    total = rows.count()
    out: dict[int, Row] = {}
    # spans: (above this key, up to this key, rows before, rows inside) -> positions
    spans: dict[tuple, list[int]] = {}
    if wanted := sorted({p for p in positions if 1 <= p <= total}):
        spans[None, None, 0, total] = wanted
    while spans:
        narrower: dict[tuple, list[int]] = {}
        for (low, high, before, inside), wanted in spans.items():
            part = rows
            if low is not None:
                part = part.where(F.col("k") > key_literal(low, schema))
            if high is not None:
                part = part.where(F.col("k") <= key_literal(high, schema))
            if inside <= SMALL:
                ordered = part.agg(F.sort_array(F.collect_list("k")).alias("k"))  # at most SMALL rows
                got = ordered.select(*[F.col("k")[p - before - 1].alias(f"k{p}") for p in wanted]).first()
                out |= {p: got[f"k{p}"] for p in wanted}
                continue
            sample = part.sample(min(1.0, 16 * RANGES / inside), seed=7).limit(64 * RANGES).distinct().orderBy("k").collect()
            cuts = [r.k for r in sample[len(sample) // RANGES::max(1, len(sample) // RANGES)]] or [part.agg(F.min("k")).first()[0]]
            place = F.size(F.filter(F.array(*[key_literal(c, schema) for c in cuts]), lambda c: c < F.col("k")))
            counted = part.groupBy(place.alias("i")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("least"), F.max("k").alias("most")).orderBy("i").collect()
            for r in counted:
                mine = [p for p in wanted if before < p <= before + r.n]
                if mine and r.least == r.most:
                    out |= dict.fromkeys(mine, r.least)
                elif mine:
                    narrower[cuts[r.i - 1] if r.i else low, cuts[r.i] if r.i < len(cuts) else high, before, r.n] = mine
                before += r.n
        spans = narrower
    return out
