"""A data layout that serves as an index: files clustered by several columns, with a list of their ranges.

Rows are dealt to files along the interleaved bits of the columns' range buckets, so a file
covers a small range of every one of them, not only of the first sort key. A filter on any of the columns, or on
all, then names few files: ``read_where`` picks them from the written list of ranges before Spark opens
any. Within the files Parquet's own statistics and Bloom filters (for keys such as the order id)
skip row groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a column's bucket number: 2 ** BITS ranges of about equally many rows.
BITS, SAMPLED = 5, 64


def range_edges(df: DataFrame, column: str, bits: int = BITS) -> list:
    """At most ``2 ** bits - 1`` edges that part the values into ranges, from a sample of ``SAMPLED`` rows a range."""
    rows = df.select(column).where(F.col(column).isNotNull())
    n, wanted = rows.count(), SAMPLED << bits
    part = rows if n <= wanted else rows.sample(fraction=1.5 * wanted / n, seed=7)
    got = [r[0] for r in part.limit(2 * wanted).orderBy(column).collect()]
    return sorted({got[i * len(got) >> bits] for i in range(1, 1 << bits)}) if got else []


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The bits of the columns' bucket numbers, highest first and in turn, as one number."""
    out = F.lit(0).cast("long")
    for c, name in enumerate(columns):
        edges = [F.lit(e).cast(df.schema[name].dataType) for e in range_edges(df, name, bits)]
        bucket = sum([F.when(F.col(name) >= e, 1).otherwise(0) for e in edges], F.lit(0))
        for bit in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(columns) + len(columns) - 1 - c))
    return out


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int, bloom: dict[str, int] | None = None, mode: str = "overwrite") -> None:
    """Write ``files`` files clustered by the columns ``by``, and their list. ``bloom``: columns with a Bloom filter and the distinct values a file may hold."""
    keyed = df.withColumn("_z", interleaved(df, by))
    writer = keyed.repartitionByRange(files, "_z", *by).sortWithinPartitions("_z", *by).drop("_z").write.mode(mode)
    for column, distinct in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    writer.parquet(path)
    ranges = [f(c).alias(f"{name}_{c}") for c in by for name, f in (("least", F.min), ("most", F.max))]
    rows = df.sparkSession.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *ranges).write.mode("overwrite").parquet(f"{path}/_ranges")


def files_where(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> list[str]:
    """The files that may hold rows whose columns lie in ``ranges`` (both ends included)."""
    listed = spark.read.parquet(f"{path}/_ranges")
    for column, (low, high) in ranges.items():
        listed = listed.where((F.col(f"most_{column}") >= F.lit(low)) & (F.col(f"least_{column}") <= F.lit(high)))
    return sorted(r.file for r in listed.select("file").collect())


def read_where(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """The rows of a clustered table whose columns lie in ``ranges``; only files that may hold some are opened."""
    schema = spark.read.parquet(path).schema
    files = files_where(spark, path, ranges)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for column, (low, high) in ranges.items():
        rows = rows.where(F.col(column).between(F.lit(low), F.lit(high)))
    return rows
