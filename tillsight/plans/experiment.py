"""Campaign A/B test: conversion summary, two-proportion z-test, intervals,
revenue projection, sample size.

Everything is one distributed aggregate over the campaign rows followed by
closed-form Column arithmetic on the one-row result (no collect).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import mean_sql, round_float_half_even as rnd
from tillsight.functions.numeric import mean_sql, round_sql, safe_div
from tillsight.functions.stats import Z_95, arm_half_width, pooled_z, proportion, two_sided_p, unpooled_se
from tillsight.sources.model import RetailTables

CONTROL, VARIANT = "control", "variant"
ALPHA = 0.05
# The two labels of the decision.
SIGNIFICANT, NOT_SIGNIFICANT = "statistically significant", "not statistically significant"
# One-sided standard normal quantiles for the usual power levels.
Z_POWER = {0.8: 0.8416212335729143, 0.9: 1.2815515655446004}


def ab_summary(t: RetailTables) -> DataFrame:
    """Per arm: n, conversions, conversion % and mean order value including zeros."""
    return t.campaign.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("converted").alias("conversions"),
        round_sql(F.lit(Decimal("100.0")) * F.sum("converted") / F.count(F.lit(1)), 2).alias("conversion_rate_pct"),
        mean_sql(t.campaign, "order_value", 2).alias("avg_order_value_incl_zero"),
    )


def _arm_counts(campaign: DataFrame) -> DataFrame:
    is_c, is_v = F.col("grp") == CONTROL, F.col("grp") == VARIANT
    return campaign.agg(
        F.count_if(is_c).alias("n1"), F.count_if(is_v).alias("n2"),
        F.coalesce(F.sum(F.when(is_c, F.col("converted"))), F.lit(0)).alias("x1"),
        F.coalesce(F.sum(F.when(is_v, F.col("converted"))), F.lit(0)).alias("x2"),
        (F.sum(F.when(F.col("converted") == 1, F.col("order_value"))).cast("double")
         / F.nullif(F.count_if(F.col("converted") == 1), F.lit(0))).alias("value_when_converted"),
    ).select("*", proportion(F.col("x1"), F.col("n1")).alias("p1"), proportion(F.col("x2"), F.col("n2")).alias("p2"))


def ab_test_result(t: RetailTables, alpha: float = ALPHA, full_base: int | None = None) -> DataFrame:
    """One row with the published result columns. ``full_base`` (customers the
    variant would be rolled out to) defaults to the size of the customer table."""
    base = F.lit(full_base) if full_base is not None else t.customers.select(F.count(F.lit(1))).scalar()
    a = _arm_counts(t.campaign)
    z = pooled_z(F.col("x1"), F.col("n1"), F.col("x2"), F.col("n2"))
    se = unpooled_se(F.col("p1"), F.col("n1"), F.col("p2"), F.col("n2"))
    lift = F.col("p2") - F.col("p1")
    staged = a.select("*", z.alias("z"), se.alias("se"), lift.alias("lift"))
    p = two_sided_p(F.col("z"))
    return staged.select(
        F.col("n1").alias("control_n"), F.col("n2").alias("variant_n"),
        rnd(F.col("p1"), 4).alias("control_conv_rate"), rnd(F.col("p2"), 4).alias("variant_conv_rate"),
        rnd(F.col("lift"), 4).alias("absolute_lift"),
        rnd((safe_div(F.col("p2"), F.col("p1")) - F.lit(1.0)) * F.lit(100.0), 2).alias("relative_lift_pct"),
        rnd(F.col("z"), 3).alias("z_stat"),
        rnd(p, 4).alias("p_value"),
        rnd(F.col("lift") - F.lit(Z_95) * F.col("se"), 4).alias("ci_95_low"),
        rnd(F.col("lift") + F.lit(Z_95) * F.col("se"), 4).alias("ci_95_high"),
        (p < F.lit(alpha)).alias("significant_at_05"),
        rnd(F.col("lift") * base * F.col("value_when_converted"), 0).alias("projected_incremental_revenue"),
    )


def ab_decision(t: RetailTables, alpha: float = ALPHA) -> DataFrame:
    """The decision at ``alpha`` as a flag and as the label of the report (no decision without a p value)."""
    a = _arm_counts(t.campaign)
    p = two_sided_p(pooled_z(F.col("x1"), F.col("n1"), F.col("x2"), F.col("n2")))
    decided = a.select(F.lit(alpha).alias("alpha"), rnd(p, 4).alias("p_value"), (p < F.lit(alpha)).alias("significant"))
    return decided.withColumn("result", F.when(F.col("significant"), SIGNIFICANT).when(~F.col("significant"), NOT_SIGNIFICANT))


def ab_arm_intervals(t: RetailTables) -> DataFrame:
    """Per arm: rate and its 95 % half-width 1.96 sqrt(p(1-p)/n)."""
    per_arm = t.campaign.groupBy("grp").agg(F.count(F.lit(1)).alias("n"),
                                             F.sum("converted").alias("conversions"))
    p = proportion(F.col("conversions"), F.col("n"))
    hw = arm_half_width(p, F.col("n"))
    return per_arm.select(
        "grp", "n", "conversions",
        rnd(p, 4).alias("conv_rate"), rnd(hw, 4).alias("half_width"),
        rnd(p - hw, 4).alias("ci_low"), rnd(p + hw, 4).alias("ci_high"),
    )


def ab_projection(t: RetailTables, full_base: int | None = None) -> DataFrame:
    """Mean value of converted orders, extra conversions per 1,000 contacted,
    projected extra revenue over the whole customer base."""
    base = F.lit(full_base) if full_base is not None else t.customers.select(F.count(F.lit(1))).scalar()
    # bind the base once (a scalar subquery runs once per reference otherwise)
    a = _arm_counts(t.campaign).select("*", base.cast("long").alias("full_base"))
    lift = F.col("p2") - F.col("p1")
    return a.select(
        rnd(F.col("value_when_converted"), 2).alias("avg_value_when_converted"),
        rnd(lift * F.lit(1000.0), 1).alias("incremental_conversions_per_1000"),
        "full_base",
        rnd(lift * F.col("full_base") * F.col("value_when_converted"), 0).alias("projected_incremental_revenue"),
    )


def ab_sample_size(t: RetailTables) -> DataFrame:
    """Customers needed per arm to detect the observed difference at two-sided
    alpha 0.05 (z = 1.96) with 80 % and 90 % power (unpooled variance)."""
    a = _arm_counts(t.campaign)
    var = F.col("p1") * (F.lit(1.0) - F.col("p1")) + F.col("p2") * (F.lit(1.0) - F.col("p2"))
    diff2 = (F.col("p2") - F.col("p1")) * (F.col("p2") - F.col("p1"))
    rows = F.array(*[F.struct(F.lit(pw).alias("power"), F.lit(zb).alias("z_beta")) for pw, zb in Z_POWER.items()])
    return a.select(var.alias("var"), diff2.alias("diff2"), F.explode(rows).alias("r")).select(
        F.col("r.power").alias("power"),
        F.ceil((F.lit(Z_95) + F.col("r.z_beta")) * (F.lit(Z_95) + F.col("r.z_beta")) * F.col("var")
               / F.nullif(F.col("diff2"), F.lit(0.0)))
        .cast("long").alias("needed_per_arm"),
    )
