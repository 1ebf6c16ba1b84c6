"""Clustered files, inferred CSV types and gapless publication."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from retail_fixtures import make_tables, money, simple_orders
from tillsight.plans import storage
from tillsight.sources import layout, publish as pub
from tillsight.sources.files import write_csv
from tillsight.sources.infer import column_types, read_csv_inferred
from tillsight.sources.publish import Refused, publish, read_published, reading, versions


def orders(n=20_000, hot=True):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        c = 77 if hot and i % 3 == 0 else rng.randrange(500)  # a third belongs to one customer
        rows.append((i, c, dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(730)), i % 100))
    return rows


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "t")
    rows = orders()
    layout.write_clustered(spark.createDataFrame(rows, "order_id long, customer_id long, order_date date, v int"), path, ["customer_id", "order_date"], 64, {"order_id": 1000})
    return path, rows


@pytest.mark.parametrize("customer", [3, 77, 450])
def test_a_customer_and_month_open_few_files(spark, clustered, customer):
    path, rows = clustered
    low, high = dt.date(2024, 3, 1), dt.date(2024, 3, 31)
    ranges = {"customer_id": (customer, customer), "order_date": (low, high)}
    every = spark.read.parquet(f"{path}/_ranges").count()
    assert every >= 50
    assert len(layout.files_where(spark, path, ranges)) < every / 10
    got = layout.read_where(spark, path, ranges)
    names = lambda files: {os.path.basename(f) for f in files}
    assert names(got.inputFiles()) <= names(layout.files_where(spark, path, ranges))
    assert sorted(r.order_id for r in got.collect()) == sorted(r[0] for r in rows if r[1] == customer and low <= r[2] <= high)


def test_either_column_alone_prunes_too(spark, clustered):
    path, rows = clustered
    every = spark.read.parquet(f"{path}/_ranges").count()
    for ranges in ({"customer_id": (3, 3)}, {"order_date": (dt.date(2024, 3, 1), dt.date(2024, 3, 31))}):
        assert len(layout.files_where(spark, path, ranges)) < every / 2
    assert layout.read_where(spark, path, {"customer_id": (9999, 9999)}).count() == 0
    assert spark.read.parquet(path).count() == len(rows) == sum(r["rows"] for r in spark.read.parquet(f"{path}/_ranges").collect())


def test_files_carry_bloom_filters_of_the_order_id(spark, clustered):
    path, _ = clustered
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    name = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    at = jvm.org.apache.hadoop.fs.Path(os.path.join(path, name))
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(conf, at)
    columns = footer.getBlocks().get(0).getColumns()
    offsets = {columns.get(i).getPath().toDotString(): columns.get(i).getBloomFilterOffset() for i in range(columns.size())}
    assert offsets["order_id"] > 0 and offsets["v"] <= 0


def test_layouts_of_few_or_no_rows_and_text_keys(spark, scratch):
    for i, rows in enumerate(([], [("b", dt.date(2024, 1, 1)), (None, None)])):
        path = os.path.join(scratch, str(i))
        layout.write_clustered(spark.createDataFrame(rows, "customer_id string, order_date date"), path, ["customer_id", "order_date"], 4)
        assert layout.read_where(spark, path, {"customer_id": ("a", "c")}).count() == (1 if rows else 0)


def test_best_customer_month(spark):
    t = simple_orders(spark, [("o1", "a", "2024-01-05", "completed", 10.0), ("o2", "a", "2024-01-25", "completed", 15.0), ("o3", "b", "2024-01-05", "completed", 24.0),
                              ("o4", "a", "2024-02-05", "completed", 20.0)])
    assert sorted(r.order_id for r in storage.best_customer_month(t).collect()) == ["o1", "o2"]


def test_the_five_csv_shapes_get_the_models_types(spark, scratch):
    from tillsight.sources.model import SCHEMAS
    t = make_tables(spark, [("CUST00001", dt.date(2024, 1, 1), "West", "Email", 0.51234), ("CUST00002", dt.date(2024, 2, 29), None, "Ads", 0.4)],
                    [("PROD0001", "Toys", money(9.5), money(4), "TOYS-0001")], [("ORD000001", "CUST00001", dt.date(2024, 3, 1), "completed", "West", "Email")],
                    [("ORD000001", "PROD0001", 2, money(9.5), money(4.25)), ("ORD000001", "PROD0001", 11, money(10), money(4))],
                    [("CUST00001", "control", 1, money(19)), ("CUST00002", "variant", 0, money("0.5"))])
    for name, df in t.as_dict().items():
        path = os.path.join(scratch, f"{name}.csv")
        write_csv(df, path)
        table, lost, _ = read_csv_inferred(spark, path)
        assert table.schema.simpleString() == SCHEMAS[name].simpleString()
        assert sorted(map(str, table.collect())) == sorted(map(str, df.collect())) and lost.count() == 0


def test_cells_that_fail_are_kept_aside(spark, scratch):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write("id,day,price,code\n" + "".join(f"{i},2024-01-{1 + i % 28:02d},{i}.5,{i:04d}\n" for i in range(97)) + "x9,2024-02-30,free,1\nx9,soon,1e3,2\n,,,\n")
    table, lost, types = read_csv_inferred(spark, path, tolerance=0.05)
    got = {r.column_name: (r.type, r.rows, r.nulls, r.failures) for r in types.collect()}
    assert got == {"id": ("int", 100, 1, 2), "day": ("date", 100, 1, 2), "price": ("decimal(12,2)", 100, 1, 2), "code": ("string", 100, 1, 0)}
    assert {(r.column_name, r.value, r.cells) for r in lost.collect()} == {
        ("id", "x9", 2), ("day", "2024-02-30", 1), ("day", "soon", 1), ("price", "free", 1), ("price", "1e3", 1)}
    assert table.where("id IS NULL").count() == 3
    strict = {r.column_name: r.type for r in read_csv_inferred(spark, path)[2].collect()}
    assert strict == dict.fromkeys(("id", "day", "price", "code"), "string")


def test_types_of_edge_values(spark):
    rows = [("007", "-5", "1.234", "9999999999", "", "2024-01-01"), ("8", "+6", "2", "1", None, "2024-1-1")]
    df = spark.createDataFrame(rows, "code string, small string, measure string, big string, empty string, loose string")
    got = {r.column_name: r.type for r in column_types(df).collect()}
    assert got == {"code": "string", "small": "int", "measure": "double", "big": "bigint", "empty": "string", "loose": "string"}
    assert {r.type for r in column_types(df.limit(0)).collect()} == {"string"}


def table(spark, n, v):
    return spark.range(n).select("id", F.lit(v).alias("v"))


def test_a_failing_write_leaves_the_old_table(spark, scratch):
    target = os.path.join(scratch, "t")
    assert publish(table(spark, 5, 1), target, ["id"]) == 1
    with pytest.raises(Exception, match="boom"):
        publish(spark.range(3).selectExpr("id", "cast(raise_error('boom') AS int) AS v"), target, ["id"])
    for bad in (table(spark, 3, 2).unionAll(table(spark, 3, 2)), table(spark, 0, 2), table(spark, 2, 2).withColumn("id", F.lit(None).cast("long"))):
        with pytest.raises(Refused):
            publish(bad, target, ["id"])
    assert versions(spark, target) == [1]
    assert sorted(map(tuple, read_published(spark, target).collect())) == [(i, 1) for i in range(5)]
    assert not [f for f in os.listdir(target) if f.startswith("_staging")]


def test_readers_keep_what_they_opened(spark, scratch):
    target = os.path.join(scratch, "t")
    for v in (1, 2):
        publish(table(spark, 5, v), target, ["id"])
    with reading(spark, target) as held:
        plain = read_published(spark, target)
        for v in (3, 4, 5):
            publish(table(spark, 5, v), target, ["id"])
        assert {r.v for r in held.collect()} == {2}
        assert versions(spark, target) == [2, 4, 5]  # 2 is held, 4 is the one before, 1 and 3 are gone
    del plain
    publish(table(spark, 5, 6), target, ["id"])
    assert versions(spark, target) == [5, 6]


def test_a_version_without_its_mark_is_no_version(spark, scratch):
    target = os.path.join(scratch, "t")
    publish(table(spark, 5, 1), target)
    os.remove(os.path.join(target, "v1", pub.MARK))
    with pytest.raises(FileNotFoundError):
        read_published(spark, target)
    assert publish(table(spark, 4, 2), target) == 1 and read_published(spark, target).count() == 4
