"""RFM scoring and segmentation.

recency   = days from the customer's last order to (data's last date + offset_days)
frequency = completed orders, monetary = revenue
r_score   = quartile bin of recency, labels 4..1 (recent is better)
f_score   = quartile bin of the ordinal rank of frequency (ties by customer_id)
m_score   = quartile bin of monetary, labels 1..4
Quartile edges are exact (linear interpolation), bins right-closed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import round_float_half_even
from tillsight.operators.quantiles import (QUARTILES, bin_score, discrete_quantiles, exact_quantiles,
                                          rank_quantile_edges)
from tillsight.operators.selection import key_literal, order_statistics
from tillsight.operators.shares import share_of_total_bounded
from tillsight.shared import written
from tillsight.sources.model import RetailTables

# Segment labels, in rule order (first match wins).
CHAMPIONS = "Champions"
LOYAL = "Loyal Customers"
PROMISING = "Promising / New"
NEEDS_ATTENTION = "Needs Attention"
AT_RISK = "At Risk"
HIBERNATING = "Hibernating / Lost"
OTHER = "Other"


def segment_of(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r >= 3) & (f >= 3) & (m >= 3), CHAMPIONS)
        .when((r >= 3) & (f >= 2), LOYAL)
        .when((r >= 3) & (f <= 2), PROMISING)
        .when((r == 2) & (f >= 2), NEEDS_ATTENTION)
        .when((r <= 2) & (f >= 3), AT_RISK)
        .when((r <= 1) & (f <= 2), HIBERNATING)
        .otherwise(OTHER)
    )


def customer_totals(t: RetailTables) -> DataFrame:
    """customer_id, last order date, frequency, monetary (one row per buying customer)."""
    return t.order_level.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"), F.count(F.lit(1)).alias("frequency"),
        F.sum("order_revenue").alias("monetary"))


def shared_customer_totals(t: RetailTables) -> DataFrame:
    """``customer_totals`` written once per model: the
    RFM inputs, scores and edges all start from it, so the order-level table is
    scanned once for all of them."""
    if "customer_totals" not in t.memo:
        t.memo["customer_totals"] = written(customer_totals(t), "customer-totals")
    return t.memo["customer_totals"]


def with_recency(totals: DataFrame, offset_days: int = 1) -> DataFrame:
    """Add recency = days from the last order to (latest last order + offset_days).
    The snapshot is the maximum over the per-customer rows, a scalar subquery."""
    snapshot = totals.select(F.date_add(F.max("last_order_date"), offset_days)).scalar()
    return totals.withColumn("recency", F.datediff(snapshot, F.col("last_order_date")))


def rfm_base(t: RetailTables, offset_days: int = 1) -> DataFrame:
    """customer_id, recency, frequency, monetary (one row per buying customer)."""
    return with_recency(customer_totals(t), offset_days).select("customer_id", "recency", "frequency", "monetary")


class RfmModel:
    """Scores plus the edges that produced them.

    Edges come from the written per-customer totals without sorting them: the frequency rank (ties by
    customer id) is cut at its quartile positions by the (frequency, id) keys found there, and monetary edges are the
    values at theirs. The scored table is written once, so that every consumer (scores, summary, top
    segment, dashboard) reads the same result.
    """

    def __init__(self, t: RetailTables, offset_days: int = 1):
        self.totals = with_recency(shared_customer_totals(t), offset_days)
        self.n_customers = self.totals.count()
        self.recency_edges = discrete_quantiles(self.totals, "recency").select("edges").scalar()
        self.monetary_edges = exact_quantiles(self.totals, "monetary", tiebreak=["customer_id"]).select("edges").scalar()
        # ranks 1..n: a rank is above the edge 1 + (n - 1) p if the key is above the one at its whole part
        cuts = [math.floor(1 + (self.n_customers - 1) * p) for p in QUARTILES]
        keys = ["frequency", "customer_id"]
        found = order_statistics(self.totals, keys, cuts)
        schema = self.totals.select(F.struct(*keys).alias("k")).schema["k"].dataType
        above = [(F.struct(*keys) > key_literal(found[c], schema)).cast("int") for c in cuts if c in found]
        self.f_score = sum(above, F.lit(1))
        self._scores: DataFrame | None = None

    def _score(self) -> DataFrame:
        # the edge arrays are bound once as columns: each scalar subquery then runs once
        bound = self.totals.select("*", self.recency_edges.alias("_r_edges"), self.monetary_edges.alias("_m_edges"))
        r = bin_score(F.col("recency"), F.col("_r_edges"), descending=True)
        m = bin_score(F.col("monetary"), F.col("_m_edges"))
        scored = bound.select(
            "customer_id", "recency", "frequency", "monetary",
            r.alias("r_score"), self.f_score.alias("f_score"), m.alias("m_score"))
        return scored.withColumn("rfm_sum", F.col("r_score") + F.col("f_score") + F.col("m_score")).withColumn(
            "segment", segment_of(F.col("r_score"), F.col("f_score"), F.col("m_score")))

    def scores(self) -> DataFrame:
        if self._scores is None:
            self._scores = written(self._score(), "rfm-scores")
        return self._scores

    def edges(self) -> DataFrame:
        def row(name: str, edges: Column) -> Column:
            return F.struct(F.lit(name).alias("metric"),
                            *[F.round(edges[i], 6).alias(f"q{q}") for i, q in enumerate((25, 50, 75))])
        one_row = self.totals.agg(F.count(F.lit(1)).alias("n_customers")).select(
            "n_customers", self.recency_edges.alias("_r_edges"), self.monetary_edges.alias("_m_edges"))
        return one_row.select(F.explode(F.array(
            row("recency", F.col("_r_edges")),
            row("frequency_rank", rank_quantile_edges(F.col("n_customers"))),
            row("monetary", F.col("_m_edges")),
        )).alias("e")).select("e.*")


def rfm_model(t: RetailTables, offset_days: int = 1) -> RfmModel:
    """One model per tables object and offset: scores, summary and edges share it."""
    key = f"rfm_model:{offset_days}"
    if key not in t.memo:
        t.memo[key] = RfmModel(t, offset_days)
    return t.memo[key]


def rfm_scores(t: RetailTables, offset_days: int = 1) -> DataFrame:
    return rfm_model(t, offset_days).scores()


def rfm_quartile_edges(t: RetailTables, offset_days: int = 1) -> DataFrame:
    return rfm_model(t, offset_days).edges()


def segment_summary(scores: DataFrame) -> DataFrame:
    """Per segment: customers, mean recency / frequency / monetary, revenue, all
    rounded to 1 decimal first, then shares of customers and revenue computed from
    the rounded figures (that order is part of the definition)."""
    def r1(c: Column) -> Column:
        return round_float_half_even(c, 1)

    summary = scores.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        r1(F.avg("recency")).alias("avg_recency_days"),
        r1(F.avg("frequency")).alias("avg_frequency"),
        r1(F.avg("monetary")).alias("avg_monetary"),
        r1(F.sum("monetary")).alias("total_revenue"),
    )
    # seven segments at most: the shares are windows over the summary itself
    return summary.select(
        "*",
        r1(share_of_total_bounded("customers")).alias("pct_of_customers"),
        r1(share_of_total_bounded("total_revenue")).alias("pct_of_revenue"),
    ).orderBy(F.desc("total_revenue"))


def rfm_segment_summary(t: RetailTables, offset_days: int = 1) -> DataFrame:
    return segment_summary(rfm_scores(t, offset_days))


def rfm_top_segment(t: RetailTables, offset_days: int = 1) -> DataFrame:
    """The segment with the largest revenue share (first in summary order on ties)."""
    s = rfm_segment_summary(t, offset_days)
    key = F.struct(F.col("pct_of_revenue"), F.col("total_revenue"))
    return s.agg(
        F.max_by("segment", key).alias("segment"),
        F.max_by("pct_of_customers", key).alias("pct_of_customers"),
        F.max_by("pct_of_revenue", key).alias("pct_of_revenue"),
    )
