"""Data quality: row/null/duplicate profile, invalid values, key constraints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.keyfilter import bits_for, key_filter, may_hold


def row_fingerprint(cols: Sequence[str]) -> Column:
    """128 bits of a row: two hashes of its values and of which are null."""
    nulls = [F.col(c).isNull() for c in cols]
    return F.struct(F.xxhash64(F.lit(1), *nulls, *cols).alias("a"), F.xxhash64(*nulls, *cols, F.lit(2)).alias("b"))


#: Repeated fingerprints that are broadcast; more are found by a filter and a join.
BROADCAST_ROWS = 1 << 20


def duplicate_rows(df: DataFrame, fingerprint: Column | None = None) -> DataFrame:
    """One row ``duplicate_rows``: exact number of copies beyond the first of equal rows (NULLs equal each other).

    Two steps. Rows are counted by a 128-bit fingerprint, partial counts first, so only fingerprints are shuffled. Then the
    rows of repeated fingerprints alone are compared in full: they are picked in the scan (a broadcast of the repeated
    fingerprints, or a Bloom filter and a join where they are too many), so a fingerprint that different rows share
    changes nothing in the count.
    """
    from tillsight.shared import written

    cols = df.columns
    marked = df.withColumn("_fp", row_fingerprint(cols) if fingerprint is None else fingerprint)
    repeated = written(marked.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_fp"), "repeated-rows")
    n = repeated.count()
    if not n:  # nothing to compare
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("duplicate_rows"))
    if n <= BROADCAST_ROWS:
        suspects = marked.join(F.broadcast(repeated), "_fp", "left_semi")
    else:
        bits = bits_for(n)
        suspects = marked.where(may_hold(key_filter(repeated, "_fp", bits), F.col("_fp"), bits)).join(repeated, "_fp", "left_semi")
    copies = suspects.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def table_profile(df: DataFrame, table: str, fingerprint: Column | None = None) -> DataFrame:
    """One row: table, rows, null_cells, duplicate_rows (copies beyond the first, by :func:`duplicate_rows`)."""
    nulls_in_row = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in df.columns])
    totals = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls_in_row), F.lit(0)).cast("long").alias("null_cells"))
    return totals.select(F.lit(table).alias("table_name"), "rows", "null_cells", duplicate_rows(df, fingerprint).scalar().alias("duplicate_rows"))


def count_where(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with ``count_if`` of every named predicate."""
    return df.agg(*[F.count_if(pred).cast("long").alias(name) for name, pred in checks.items()])


def primary_key_violations(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """table_name, key_columns, duplicated_keys, null_keys."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(key)).alias("key_columns"),
        F.count_if(F.col("_n") > 1).cast("long").alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
    )


@dataclass(frozen=True)
class Reference:
    """``child.column`` refers to ``parent.key``."""

    child: str
    column: str
    parent: str
    key: str


def _as_key(value: Column, own: str, other: str) -> Column:
    """A reference or a key as its table has it where both are integers (as longs) or of one text type, else as text."""
    whole = ("byte", "short", "integer", "long")
    return value.cast("long" if own in whole and other in whole else "string")


def foreign_key_orphans(tables: dict[str, DataFrame], references: Sequence[Reference], bits: int | None = None) -> DataFrame:
    """child_table, child_column, parent_table, orphan_rows: rows whose non-null reference has no parent row.

    Every table is scanned once, for the columns that references and keys read, and these are written (without the rest of the
    rows). A reference is counted by its value, partial counts first, and an exact anti join with the parent's keys, in their
    own type, leaves the orphans. With ``bits``, a Bloom filter of that size first parts the values that are no key for
    certain; they need no join.
    """
    from tillsight.shared import written

    need = {}
    for r in references:
        need.setdefault(r.child, set()).add(r.column)
        need.setdefault(r.parent, set()).add(r.key)
    kinds = {(n, c): tables[n].schema[c].dataType.typeName() for n, cols in need.items() for c in cols}
    scanned = {n: written(tables[n].select(*sorted(cols)), f"keys-{n}") for n, cols in sorted(need.items())}
    parts = []
    for i, r in enumerate(references):
        own, other = kinds[r.child, r.column], kinds[r.parent, r.key]
        asked = scanned[r.child].select(_as_key(F.col(r.column), own, other).alias("key")).where("key IS NOT NULL")
        owned = scanned[r.parent].select(_as_key(F.col(r.key), other, own).alias("key")).where("key IS NOT NULL")
        counted = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        lost = counted.join(owned, "key", "left_anti")
        if bits:
            known = may_hold(key_filter(owned, "key", bits), F.col("key"), bits)
            lost = counted.where(~known).select("key", "n").unionAll(counted.where(known).join(owned, "key", "left_anti"))
        parts.append(lost.agg(F.lit(r.child).alias("child_table"), F.lit(r.column).alias("child_column"), F.lit(r.parent).alias("parent_table"),
                              F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphan_rows")))
    return reduce(DataFrame.unionAll, parts)
