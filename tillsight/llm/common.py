"""Helpers shared by the operators: tables, shared intermediates, id filters."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.session import delete_at_exit, ensure_checkpoint_dir


#: Rows of an Arrow batch: whole texts may be long, and a worker holds a batch or two.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ``BATCH_ROWS`` where they are larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder of ``spark.checkpoint.dir``.

    It is removed when the application ends.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hpath)
    delete_at_exit(spark, path)
    return path


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Later readers start from these files, so a lost executor costs a re-read,
    and scans of the table prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.mode("append").parquet(path, **options)
    return spark.read.schema(schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a table of :func:`written` that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text):
    """Lower-case A-Z only; other letters stay as they are.

    ``lower`` has a fast path for ASCII text, where both mean the same.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def id_type(docs: DataFrame, column: str = "doc_id") -> str:
    """The type in which ids are carried: long for integers, string for any other."""
    return "long" if docs.schema[column].dataType.typeName() in ("byte", "short", "integer", "long") else "string"


def id_crc32(column):
    """crc32 of an id written as text."""
    return F.crc32(column.cast("string").cast("binary"))


#: Bits of an id filter: a fixed 1 MB, whatever the number of ids.
FILTER_BITS = 1 << 23
#: Longs of a filter's row.
FILTER_LONGS = 16


def _filter_place(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame, column: str) -> DataFrame:
    """A bitmap of fixed size that holds every id of ``column`` (and, by hash
    collisions, some others), in at most ``FILTER_BITS / 64 / FILTER_LONGS`` rows. It only saves
    shuffling rows that no later join keeps; the join itself stays exact."""
    places = ids.where(F.col(column).isNotNull()).select(_filter_place(column).alias("at")).selectExpr(
        f"at div {64 * FILTER_LONGS} AS __cell", f"cast(at div 64 % {FILTER_LONGS} AS int) AS slot", "shiftleft(1L, cast(at % 64 AS int)) AS bit")
    longs = [F.coalesce(F.bit_or(F.when(F.col("slot") == k, F.col("bit"))), F.lit(0).cast("long")) for k in range(FILTER_LONGS)]
    return written(places.groupBy("__cell").agg(F.array(*longs).alias("__bits")), "id-filter")


def filtered(rows: DataFrame, column: str, bitmap: DataFrame) -> DataFrame:
    """The rows whose id may be in the bitmap of :func:`id_filter`."""
    at = _filter_place(column)
    keyed = rows.withColumn("__at", at).withColumn("__cell", F.expr(f"__at div {64 * FILTER_LONGS}"))
    kept = keyed.join(F.broadcast(bitmap), "__cell").where(F.expr(f"getbit(__bits[cast(__at div 64 % {FILTER_LONGS} AS int)], cast(__at % 64 AS int)) = 1"))
    return kept.select(rows.columns)


#: Key rows that are broadcast to drop rows; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20


def without(docs: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``docs`` that match no row of ``keys`` (a written table, distinct)."""
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, "left_anti")
