"""Shared intermediate tables: Parquet below the configured checkpoint folder.

Readers prune columns and push filters into these files, and a lost executor
costs a re-read. ``discard`` deletes what a session has written; what is left
goes when the application ends. Spark Connect gives no access to the file API:
there the files stay, and changed inputs need a new session.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.session import checkpoint_dir, context, delete_at_exit, session_key

_WRITTEN: dict[str, list[str]] = {}


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's file API, the one Spark's readers use."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, deleted by :func:`discard` or when the application ends."""
    folder = checkpoint_dir(spark)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: shared tables and ordinal ranks are written there")
    path = f"{folder.rstrip('/')}/tillsight-{name}-{uuid.uuid4().hex}"
    if context(spark) is not None:
        fs, at = hadoop_path(spark, path)
        fs.mkdirs(at)  # so that it can be registered before the write, which may fail
        delete_at_exit(spark, path)
        _WRITTEN.setdefault(session_key(spark), []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of keys that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20


def small(keys: DataFrame) -> DataFrame:
    """``keys`` (a written table) with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def discard(spark: SparkSession) -> None:
    """Delete the tables that this session has written; DataFrames that read them stop working."""
    for path in _WRITTEN.pop(session_key(spark), []):
        fs, at = hadoop_path(spark, path)
        fs.delete(at, True)


def fingerprint(spark: SparkSession, folder: str, names: list[str]) -> tuple:
    """(file, length, modification time) of every file of the Parquet tables ``names`` in ``folder``."""
    found = []
    if context(spark) is None:
        return ()
    for name in names:
        fs, at = hadoop_path(spark, os.path.join(folder, f"{name}.parquet"))
        if not fs.exists(at):
            continue
        files = fs.listFiles(at, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))
