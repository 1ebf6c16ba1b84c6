"""Column types of text files, found in one distributed pass.

Every cell is tested against the lattice integer < decimal < text and date < text; per column one
aggregation counts what passes, with the digits seen. The narrowest type that (nearly) all non-empty cells pass
is the column's: ``int`` up to 9 digits, else ``bigint``; numbers with at most two decimals are amounts,
``decimal(12,2)`` or wider, with more they are measurements, ``double``. Cells that do not pass become NULL and a row in the table of rejected cells, instead of an
error. Empty cells are nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What an integer, a decimal and a date look like. Numbers with leading zeros are codes, that is text.
INTEGER = r"^[+-]?(0|[1-9][0-9]{0,17})$"
DECIMAL = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _tests(cell: Column) -> dict[str, Column]:
    return {"integer": cell.rlike(INTEGER), "decimal": cell.rlike(DECIMAL), "date": cell.rlike(DATE) & F.try_to_date(cell, "yyyy-MM-dd").isNotNull()}


def column_types(raw: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """column_name, type, rows, nulls, failures, integers, decimals, dates of a table of texts.

    A type is taken if at most a share ``tolerance`` of the non-empty cells fails it."""
    stats = []
    for c in raw.columns:
        cell = F.col(f"`{c}`")
        full = cell.isNotNull() & (cell != "")
        tests = _tests(cell)
        whole = F.length(F.regexp_extract(cell, r"([0-9]+)", 1))
        stats.append(F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(full, F.lit(False))).alias("nulls"),
                              *[F.count_if(full & ok).alias(f"{name}s") for name, ok in tests.items()],
                              F.max(F.when(full & tests["decimal"], whole)).alias("whole"),
                              F.max(F.when(full & tests["decimal"], F.length(F.regexp_extract(cell, r"\.([0-9]+)", 1)))).alias("fraction")))
    found = raw.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    full = F.col("rows") - F.col("nulls")
    fits = lambda name: (full > 0) & (full - F.col(name) <= full * tolerance)
    number = F.when(F.col("whole") <= 9, "int").otherwise("bigint")
    amount = F.when(F.col("fraction") <= 2, F.concat(F.lit("decimal("), F.greatest(F.least(F.col("whole") + 2, F.lit(38)), F.lit(12)).cast("string"), F.lit(",2)"))).otherwise("double")
    kind = F.when(fits("integers"), number).when(fits("dates"), "date").when(fits("decimals"), amount).otherwise("string")
    passed = F.when(fits("integers"), F.col("integers")).when(fits("dates"), F.col("dates")).when(fits("decimals"), F.col("decimals")).otherwise(full)
    return found.select("column_name", kind.alias("type"), "rows", "nulls", (full - passed).alias("failures"), "integers", "decimals", "dates")


def typed(raw: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The table with its columns cast, and (column_name, value, cells) of the cells that have no value of the type."""
    columns, rejects = [], []
    for c in raw.columns:
        cell, kind = F.nullif(F.col(f"`{c}`"), F.lit("")), types.get(c, "string")
        if kind == "date":
            value = F.try_to_date(F.when(cell.rlike(DATE), cell), "yyyy-MM-dd")
        else:
            value = cell if kind == "string" else F.when(cell.rlike(INTEGER if kind.endswith("int") else DECIMAL), cell).try_cast(kind)
        columns.append(value.alias(c))
        rejects.append(F.when(cell.isNotNull() & value.isNull(), F.struct(F.lit(c).alias("column_name"), cell.alias("value"))))
    lost = raw.select(F.explode(F.array_compact(F.array(*rejects))).alias("r")).select("r.*").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cells"))
    return raw.select(*columns), lost


def read_csv_inferred(spark: SparkSession, path: str, tolerance: float = 0.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, rejected cells, column types) of the CSV files at ``path`` with a header."""
    raw = spark.read.option("header", True).csv(path)
    raw = spark.read.schema(", ".join(f"`{c}` string" for c in raw.columns)).option("header", True).option("enforceSchema", False).csv(path)
    types = column_types(raw, tolerance)
    table, lost = typed(raw, {r.column_name: r.type for r in types.collect()})  # a row per column
    return table, lost, types
