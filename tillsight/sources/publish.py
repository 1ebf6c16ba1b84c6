"""Replace a table without a gap: stage, check, rename; readers keep the version they opened.

A new version is written beside the table, read back and checked (rows, null and repeated keys), and only then
renamed to its version folder and marked. The newest marked version is the table, so a write that
fails, or fails its checks, leaves the old one as it was. Older versions go when a later one is published,
except those that a reader holds (a small lease file) and the one before.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.shared import hadoop_path

MARK = "_PUBLISHED"


class Refused(ValueError):
    """A staged version did not pass its checks."""


def versions(spark: SparkSession, target: str) -> list[int]:
    """The published versions, oldest first."""
    fs, at = hadoop_path(spark, target)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and fs.exists(hadoop_path(spark, f"{target}/{n}/{MARK}")[1]))


def checked(staged: DataFrame, keys: Sequence[str], least_rows: int) -> int:
    """Rows of ``staged``; raises if there are too few, or keys are null or repeat."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    rows, nulls = staged.agg(F.count(F.lit(1)), F.count_if(any_null)).first()
    repeated = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count() if keys else 0
    if rows < least_rows or nulls or repeated:
        raise Refused(f"{rows} rows (at least {least_rows} wanted), {nulls} with a null key, {repeated} keys repeat")
    return rows


def publish(df: DataFrame, target: str, keys: Sequence[str] = (), least_rows: int = 1) -> int:
    """Make ``df`` the next version of the table at ``target`` and return its number."""
    spark = df.sparkSession
    staging = os.path.join(target, f"_staging-{uuid.uuid4().hex}")
    fs, at = hadoop_path(spark, staging)
    try:
        df.write.parquet(staging)
        checked(spark.read.schema(df.schema).parquet(staging), keys, least_rows)
        there = versions(spark, target)
        number = there[-1] + 1 if there else 1
        _, place = hadoop_path(spark, os.path.join(target, f"v{number}"))
        if fs.exists(place):  # renamed by a run that ended before its mark
            fs.delete(place, True)
        if not fs.rename(at, place):
            raise OSError(f"cannot rename {staging} to v{number}")
        fs.create(hadoop_path(spark, f"{target}/v{number}/{MARK}")[1], True).close()
    finally:
        fs.delete(at, True)
    for old in there[:-1]:
        if not _held(spark, target, old):
            fs.delete(hadoop_path(spark, os.path.join(target, f"v{old}"))[1], True)
    return number


def _held(spark: SparkSession, target: str, number: int) -> bool:
    fs, at = hadoop_path(spark, os.path.join(target, "_readers", f"v{number}"))
    return fs.exists(at) and len(fs.listStatus(at)) > 0


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """The newest version. The one before stays readable until the next publication; a longer job takes :func:`reading`."""
    there = versions(spark, target)
    if not there:
        raise FileNotFoundError(f"nothing is published at {target}")
    return spark.read.parquet(os.path.join(target, f"v{there[-1]}"))


@contextmanager
def reading(spark: SparkSession, target: str) -> Iterator[DataFrame]:
    """The newest version, kept from deletion while the block runs."""
    number = versions(spark, target)[-1]
    fs, lease = hadoop_path(spark, os.path.join(target, "_readers", f"v{number}", uuid.uuid4().hex))
    fs.create(lease, True).close()
    try:
        yield spark.read.parquet(os.path.join(target, f"v{number}"))
    finally:
        fs.delete(lease, False)
