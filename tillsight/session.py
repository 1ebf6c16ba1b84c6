"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins from runtime sizes (a side is
# broadcast only when its measured size is under the threshold), merges small
# shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tillsight", extra: dict | None = None) -> SparkSession:
    """Return a session with the defaults above.

    On a cluster ``master`` stays None (spark-submit decides) and
    ``spark.checkpoint.dir`` comes from the cluster configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def session_key(spark: SparkSession) -> str:
    """A key for per-application memos."""
    sc = context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder in effect, if any."""
    sc = context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    return sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None


_DELETED_AT_EXIT: set[str] = set()


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the existing ``path``, a folder of this application alone, deleted when the JVM ends.

    Hadoop takes only paths that exist; it says whether it did."""
    if path in _DELETED_AT_EXIT:
        return
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at):
        raise RuntimeError(f"{path} does not exist, so it cannot be deleted when the application ends")
    _DELETED_AT_EXIT.add(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a scratch one only when
    it is unset *and* the session runs in local mode (tests, laptop runs).

    On a cluster the setting must name a shared folder (checkpoints have to
    survive lost executors), so a missing setting is an error there rather than
    a silent fall-back to a machine-local folder.
    """
    sc = context(spark)
    configured = checkpoint_dir(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not configured:
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="tillsight-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        delete_at_exit(spark, sc.getCheckpointDir() or configured)
        return sc.getCheckpointDir() or configured
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured
