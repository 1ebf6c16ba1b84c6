"""Keep a written order-level table current, month by month.

``refresh`` compares the input files with a manifest of those that each written month
was built from, finds the months that added, removed or changed files can alter, rebuilds those alone
and overwrites their partitions; the other months' files stay as they are.

The manifest has a row per input file and month:
  * an orders file and each month of its orders, of any status;
  * a lines file and each month of an order, of any status, that it has lines for, or ``UNMATCHED``
    for lines whose order has not come yet;
  * every file with ``PRESENT``, so that a file without rows is known too.
A removed or changed file touches the months it is listed with. An added orders file touches
the months of its orders, an added lines file those of the completed orders it has lines for. For
touched months only the files listed with them are read, besides added files and lines files with
unmatched lines: late lines, late orders, and orders moved to another month or status are all
covered, and the result equals a full build (tested).

Months are written first, then the next version of the manifest: a run that fails in between is
repeated by the next one. A change of a dimension file (a customer's region is copied onto the orders)
rebuilds everything.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.plans.order_level import build_order_level, completed_orders, with_revenue
from tillsight.shared import hadoop_path, small, written
from tillsight.sources.adapter import order_items_of, orders_of, read_driver_table, retail_from_driver

UNDATED, UNMATCHED, PRESENT = "undated", "unmatched", "present"
_MANIFEST = "table string, file string, length long, modified timestamp, order_month string"


@dataclass(frozen=True)
class Facts:
    """Orders and lines of the model by input files, with the column ``file``; folders of both and of the dimensions."""

    orders: Callable[[Sequence[str]], DataFrame]
    items: Callable[[Sequence[str]], DataFrame]
    folders: dict[str, str]
    dimensions: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: months written anew (None: all) and the files it found added or gone."""

    months: list[str] | None
    added: list[str]
    removed: list[str]


def month_name(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNDATED))


def _same_form(path: Column) -> Column:
    """A file's path as the file listing writes it."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def warehouse_facts(spark: SparkSession, sf_dir: str, facts_dir: str | None = None) -> Facts:
    """The warehouse tables of a folder; ``orders`` and ``lineitem`` (in ``facts_dir``, if given) may be folders of files."""
    facts_dir = facts_dir or sf_dir
    customers = retail_from_driver(spark, sf_dir).customers

    def raw(name: str, files: Sequence[str]) -> DataFrame:
        rows = read_driver_table(spark, sf_dir, name, files)
        path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))) if files else F.lit("")
        return rows.withColumn("file", _same_form(path))

    folders = {t: os.path.join(facts_dir if t in ("orders", "lineitem") else sf_dir, f"{t}.parquet") for t in ("orders", "lineitem", "customer", "nation", "region")}
    return Facts(lambda files: orders_of(raw("orders", files), customers, keep=["file"]), lambda files: order_items_of(raw("lineitem", files), keep=["file"]),
                 {"orders": folders["orders"], "items": folders["lineitem"]}, [folders[d] for d in ("customer", "nation", "region")])


def listing(spark: SparkSession, facts: Facts) -> DataFrame:
    """table, file, length, modified of every input file; only the file system is asked."""
    parts = []
    for table, folder in [*facts.folders.items(), *(("dimension", d) for d in facts.dimensions)]:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        parts.append(files.select(F.lit(table).alias("table"), _same_form(F.col("path")).alias("file"), "length", F.col("modificationTime").alias("modified")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _versions(spark: SparkSession, target: str) -> list[int]:
    fs, at = hadoop_path(spark, os.path.join(target, "manifest"))
    if not fs.exists(at):
        return []
    names = [s.getPath() for s in fs.listStatus(at)]
    done = [p.getName() for p in names if fs.exists(hadoop_path(spark, f"{p}/_SUCCESS")[1])]
    return sorted(int(n.removeprefix("v")) for n in done)


def manifest(spark: SparkSession, target: str) -> DataFrame | None:
    """The newest complete manifest of ``target``."""
    versions = _versions(spark, target)
    return spark.read.schema(_MANIFEST).parquet(os.path.join(target, "manifest", f"v{versions[-1]}")) if versions else None


def _column(rows: DataFrame, name: str) -> list:
    return [r[0] for r in rows.select(name).distinct().collect()]


def refresh(spark: SparkSession, facts: Facts, target: str) -> Refreshed:
    """Bring ``target``/order_level up to date with the input files."""
    now = written(listing(spark, facts), "listing")
    old = manifest(spark, target)
    known = spark.createDataFrame([], now.schema) if old is None else old.drop("order_month").distinct()
    added, gone = written(now.exceptAll(known), "added"), known.exceptAll(now)
    changed = _column(added.where("table = 'dimension'"), "file") + _column(gone.where("table = 'dimension'"), "file")
    if old is None or changed:
        added, gone, old = now, spark.createDataFrame([], now.schema), None
    new = {t: _column(added.where(F.col("table") == t), "file") for t in ("orders", "items")}
    removed = _column(gone, "file")
    if not removed and not any(new.values()):
        return Refreshed([], [], [])

    month = month_name(F.col("order_date"))
    all_orders = _column(now.where("table = 'orders'"), "file")
    old = old if old is not None else spark.createDataFrame([], _MANIFEST)
    left = old.join(gone.select("file").distinct(), "file", "left_anti")  # rows of files that are as they were
    months = None
    if left.take(1):
        touched = old.join(gone.select("file").distinct(), "file", "left_semi").select("order_month")
        touched = touched.unionAll(facts.orders(new["orders"]).select(month))
        arrived = small(written(facts.items(new["items"]).select("order_id").distinct(), "arrived"))
        touched = touched.unionAll(completed_orders(facts.orders(all_orders)).join(arrived, "order_id", "left_semi").select(month))
        months = sorted(set(_column(touched.where(~F.col("order_month").isin(UNMATCHED, PRESENT)), "order_month")))  # the months spanned
        listed = left.where(F.col("order_month").isin([*months, UNMATCHED]))
        read = {t: sorted({*new[t], *_column(listed.where(F.col("table") == t), "file")}) for t in ("orders", "items")}
    else:
        read = new

    # lines are read once: revenue per order and file gives the order level and the manifest; files go by number, not by their long paths
    lines = facts.items(read["items"])
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(read["items"])], "file string, number int")
    numbered = lines.select("order_id", "file", (F.col("quantity") * F.col("unit_price")).alias("revenue")).join(F.broadcast(numbers), "file", "left")
    sums = written(numbered.groupBy("order_id", "number").agg(F.sum("revenue").alias("revenue")), "order-file-sums")
    wanted = build_order_level(facts.orders(read["orders"]), lines).schema["order_revenue"].dataType
    revenue = sums.groupBy("order_id").agg(F.sum("revenue").cast(wanted).alias("order_revenue"))
    level = with_revenue(completed_orders(facts.orders(read["orders"])), revenue).withColumn("order_month", month)
    if months is not None:
        level = level.where(F.col("order_month").isin(months))
    if months is None or months:
        _write_months(spark, level, os.path.join(target, "order_level"), months)

    by_month = facts.orders(new["orders"]).select(F.lit("orders").alias("table"), "file", month.alias("order_month")).distinct()
    dated = facts.orders(all_orders).select("order_id", F.trunc("order_date", "MM").alias("of"), F.lit(True).alias("found"))
    by_line = (sums.select("order_id", "number").join(dated, "order_id", "left").select("number", "of", "found").distinct().join(F.broadcast(numbers), "number")
               .select(F.lit("items").alias("table"), "file", F.when(F.col("found"), month_name(F.col("of"))).otherwise(UNMATCHED).alias("order_month")))
    found = now.join(by_month.unionAll(by_line), ["table", "file"]).select("table", "file", "length", "modified", "order_month")
    present = added.select("*", F.lit(PRESENT).alias("order_month"))
    reread = spark.createDataFrame([(f,) for f in read["items"]], "file string")
    kept = left.join(reread, "file", "left_anti").unionByName(left.where(F.col("order_month") == PRESENT).join(reread, "file", "left_semi"))
    versions = _versions(spark, target)
    nxt = versions[-1] + 1 if versions else 0
    kept.unionByName(found).unionByName(present).write.mode("overwrite").parquet(os.path.join(target, "manifest", f"v{nxt}"))
    for v in versions[:-1]:  # the version before stays for readers that have begun
        fs, at = hadoop_path(spark, os.path.join(target, "manifest", f"v{v}"))
        fs.delete(at, True)
    return Refreshed(months, sorted(f for fs in new.values() for f in fs), sorted(removed))


def _write_months(spark: SparkSession, level: DataFrame, path: str, months: list[str] | None) -> None:
    """Overwrite the partitions of ``months`` (None: all); a month without rows any more loses its folder."""
    def files(month: str) -> set[str]:
        fs, at = hadoop_path(spark, os.path.join(path, f"order_month={month}"))
        return {s.getPath().getName() for s in fs.listStatus(at)} if fs.exists(at) else set()

    before = {m: files(m) for m in months or []}
    writer = level.hint("rebalance", "order_month").write.mode("overwrite").partitionBy("order_month")
    (writer if months is None else writer.option("partitionOverwriteMode", "dynamic")).parquet(path)
    for m, names in before.items():
        if names and files(m) == names:  # file names are new with every write: nothing was written for it
            fs, at = hadoop_path(spark, os.path.join(path, f"order_month={m}"))
            fs.delete(at, True)


def read_refreshed(spark: SparkSession, target: str) -> DataFrame:
    """The order-level table of ``target`` with its partition column ``order_month`` (text, ``undated`` without a date)."""
    rows = spark.read.parquet(os.path.join(target, "order_level"))
    return rows.withColumn("order_month", F.col("order_month").cast("string"))
