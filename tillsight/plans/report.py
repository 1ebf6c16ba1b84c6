"""The dashboard dataset: every chart's data in one nested document.

Each part is a small aggregate (months, categories, region x channel cells,
segments, cohort x period cells, one A/B row); the parts are attached to the
KPI row as scalar subqueries, so no part is joined to another and nothing
passes through the driver.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.dates import iso_date, month_label, months_between_calendar
from tillsight.functions.numeric import clip, round_float_half_even
from tillsight.functions.text import percent_text, thousands_text
from tillsight.plans import cohort, experiment, rfm, sales
from tillsight.sources.model import RetailTables


def _labels_values(df: DataFrame, order: Column, label: Column, value: Column) -> Column:
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("o"), label.alias("l"), value.alias("v"))))
    return F.struct(F.transform(pairs, lambda p: p["l"]).alias("labels"),
                    F.transform(pairs, lambda p: p["v"]).alias("values"))


def _monthly(t: RetailTables) -> Column:
    m = sales.monthly_revenue_filled(t)
    return m.select(_labels_values(m, F.col("month"), month_label(F.col("month")),
                                   F.round(F.col("revenue").cast("double"), 2))).scalar()


def _category(t: RetailTables) -> Column:
    c = sales.category_revenue(t)
    return c.select(_labels_values(c, -F.col("revenue"), F.col("category"),
                                   F.round(F.col("revenue").cast("double"), 2))).scalar()


def _region_channel(t: RetailTables) -> Column:
    cells = sales.region_channel_long(t)
    # a complete grid: regions x channels seen, NULL where a cell has no revenue
    rows = cells.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct(
        "acquisition_channel", F.round(F.col("revenue").cast("double"), 0)))).alias("m"))
    # one row per region here, so the axis can be gathered with a window
    axis = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.map_keys("m")).over(Window.partitionBy()))))
    grid = rows.withColumn("channels", axis).select(
        "region", "channels", F.transform(F.col("channels"), lambda ch: F.element_at(F.col("m"), ch)).alias("row"))
    pairs = F.sort_array(F.collect_list(F.struct("region", "row")))
    return grid.select(F.struct(
        F.transform(pairs, lambda p: p["region"]).alias("regions"),
        F.first("channels").alias("channels"),
        F.transform(pairs, lambda p: p["row"]).alias("matrix"),
    )).scalar()


def _rfm(t: RetailTables) -> Column:
    s = rfm.rfm_segment_summary(t)
    fields = ["segment", "customers", "avg_recency_days", "avg_frequency", "avg_monetary",
              "total_revenue", "pct_of_customers", "pct_of_revenue"]
    rows = F.sort_array(F.collect_list(F.struct(-F.col("total_revenue"), F.struct(*fields).alias("r"))))
    return s.select(F.transform(rows, lambda x: x["r"])).scalar()


def _cohort(t: RetailTables) -> Column:
    ret = cohort.purchase_cohort_retention(t)
    per = ret.groupBy("cohort_month").agg(
        F.map_from_entries(F.collect_list(F.struct(
            "period", F.round(F.col("retention") * F.lit(100.0), 1)))).alias("m"),
        F.max("period").alias("_p"))
    # the period axis spans the longest cohort; at most one row per cohort here
    per = per.withColumn("_maxp", F.max("_p").over(Window.partitionBy()))
    rows = per.select("cohort_month", "_maxp", F.transform(
        F.sequence(F.lit(0), F.col("_maxp")), lambda p: F.element_at(F.col("m"), p)).alias("row"))
    pairs = F.sort_array(F.collect_list(F.struct("cohort_month", "row")))
    return rows.select(F.struct(
        F.transform(pairs, lambda p: iso_date(p["cohort_month"])).alias("cohorts"),
        F.transform(F.sequence(F.lit(0), F.max("_maxp")), lambda p: p.cast("string")).alias("periods"),
        F.transform(pairs, lambda p: p["row"]).alias("matrix"),
    )).scalar()


def _ab(t: RetailTables) -> Column:
    r = experiment.ab_test_result(t)
    return r.select(F.struct(*r.columns)).scalar()


def dashboard_dataset(t: RetailTables) -> DataFrame:
    """One row: monthly, category, region_channel, rfm, cohort, ab_test, kpis."""
    k = sales.kpis(t)
    return k.select(
        _monthly(t).alias("monthly"),
        _category(t).alias("category"),
        _region_channel(t).alias("region_channel"),
        _rfm(t).alias("rfm"),
        _cohort(t).alias("cohort"),
        _ab(t).alias("ab_test"),
        F.struct(F.round("total_revenue", 0).cast("double").alias("total_revenue"), "total_orders",
                 "total_customers", F.col("aov").cast("double").alias("aov")).alias("kpis"),
    )


def dashboard_json(t: RetailTables) -> DataFrame:
    """The same document as one JSON text column (what the page embeds)."""
    d = dashboard_dataset(t)
    return d.select(F.to_json(F.struct(*d.columns)).alias("document"))


def dashboard_sections(t: RetailTables) -> DataFrame:
    """The dashboard's numbers in long form: section, position, row_label, column_label, value, display, heat.

    The charts' labels and values, the region x channel matrix in dollars and in thousands, the segments, the cohort matrix
    in % (only cells with activity), the A/B row and the KPIs. ``display`` is the text on the chart, where it
    has one; ``heat`` the colour scale of the cohort heatmap, 0 to 1."""
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def rows(df: DataFrame, section: str, position: Column, row: Column, column: Column, value: Column, display: Column = text, heat: Column = none) -> DataFrame:
        return df.select(F.lit(section).alias("section"), position.cast("long").alias("position"), row.alias("row_label"), column.alias("column_label"),
                         value.cast("double").alias("value"), display.alias("display"), heat.alias("heat"))

    def unpivoted(df: DataFrame, section: str, names: list[str], row: Column, position: Column) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("n"), F.col(n).cast("double").alias("v")) for n in names])
        long = df.select(row.alias("r"), position.alias("p"), F.explode(pairs).alias("x"))
        return rows(long, section, F.col("p"), F.col("r"), F.col("x.n"), F.col("x.v"))

    months = sales.monthly_revenue_filled(t)
    first = F.min("month").over(Window.partitionBy())  # months spanned
    months = months.withColumn("p", months_between_calendar(F.col("month"), first))
    category = sales.category_revenue(t).withColumn("p", F.row_number().over(Window.orderBy(F.desc("revenue"), "category")) - 1)  # categories
    cells = sales.region_channel_long(t)
    thousands = F.round(F.col("revenue") * F.lit(Decimal("0.001")), 0)
    segments = rfm.rfm_segment_summary(t)
    segments = segments.withColumn("p", F.row_number().over(Window.orderBy(F.desc("total_revenue"), "segment")) - 1)  # seven at most
    share = round_float_half_even(F.col("retention") * 100.0, 1)
    ret = cohort.purchase_cohort_retention(t)
    ab = experiment.ab_test_result(t)
    kpis = sales.kpis(t).select(F.round("total_revenue", 0).alias("total_revenue"), "total_orders", "total_customers", "aov")
    zero, total = F.lit(0), F.lit("total")
    parts = [
        rows(months, "monthly", F.col("p"), month_label(F.col("month")), F.lit("revenue"), F.round("revenue", 2)),
        rows(category, "category", F.col("p"), F.col("category"), F.lit("revenue"), F.round("revenue", 2)),
        rows(cells, "region_channel", zero, F.col("region"), F.col("acquisition_channel"), F.round("revenue", 0)),
        rows(cells, "region_channel_k", zero, F.col("region"), F.col("acquisition_channel"), thousands, thousands_text(thousands * 1000)),
        unpivoted(segments, "rfm", [c for c in segments.columns if c not in ("segment", "p")], F.col("segment"), F.col("p")),
        rows(ret, "cohort", F.col("period"), iso_date(F.col("cohort_month")), F.concat(F.lit("M+"), F.col("period").cast("string")), share,
             percent_text(F.rint(share) / 100.0, 0), clip(share / 100.0, 0.0, 1.0)),
        unpivoted(ab.withColumn("significant_at_05", F.col("significant_at_05").cast("int")), "ab_test", ab.columns, total, zero),
        unpivoted(kpis, "kpis", kpis.columns, total, zero),
    ]
    return reduce(DataFrame.unionByName, parts)
