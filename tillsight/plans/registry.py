"""Registered queries.

``plans()`` maps each name to a function of the retail model and parameters,
usable on any source of the model (warehouse tables, CSV exports).
``queries()`` binds them to the warehouse tables of a folder: each call builds
(or reuses) the model over ``sf_dir`` and runs the plan over all of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillsight.plans import arrivals, cells, cohort, customers, experiment, quality, report, rfm, sales, storage
from tillsight.operators.sampling import assign_arm, sample_exact_n
from tillsight.plans.present import present
from tillsight.session import session_key
from tillsight.shared import discard, fingerprint
from tillsight.sources.adapter import DRIVER_SCHEMAS, retail_from_driver
from tillsight.sources.model import RetailTables

# Fixed value: the channel domain of the mapped model (customer market segments).
CHANNELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@dataclass(frozen=True)
class Params:
    """Knobs of the queries. ``channels=None`` lets the pivot find the channels, ``cohort_periods=None`` the periods."""

    channels: list[str] | None = None
    cohort_periods: int | None = None
    active_year: int = 2024
    lapsed_year: int = 2025
    top_k: int = 5
    recency_offset_days: int = 1
    # fixed values of the sampling step: 1,500 customers, seed 7
    sample_n: int = 1500
    sample_seed: str = "7"
    arm_salt: str = "arm"


# The warehouse mapping: years 2000 / 2001 stand for 2024 / 2025; orders from 1995-01 to 2001-08 span 80 months.
DRIVER_PARAMS = Params(channels=CHANNELS, cohort_periods=80, active_year=2000, lapsed_year=2001)

Plan = Callable[[RetailTables, Params], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]


def plans() -> dict[str, Plan]:
    """Every query as a function of the retail model and the parameters."""
    return {
        "monthly_revenue_growth": lambda t, p: sales.monthly_revenue_growth(t),
        "category_margin": lambda t, p: sales.category_margin(t),
        "order_level": lambda t, p: t.order_level,
        "kpis": lambda t, p: sales.kpis(t),
        "monthly_revenue_filled": lambda t, p: sales.monthly_revenue_filled(t),
        "monthly_revenue_filled_by_cell": lambda t, p: sales.monthly_revenue_filled_by_cell(t),
        "category_revenue": lambda t, p: sales.category_revenue(t),
        "region_channel_long": lambda t, p: sales.region_channel_long(t),
        "region_channel_matrix": lambda t, p: sales.region_channel_matrix(t, p.channels),
        "channel_rank_by_region": lambda t, p: sales.channel_rank_by_region(t),
        "revenue_share_of_max": lambda t, p: sales.revenue_share_of_max(t),
        "trend_insight": lambda t, p: sales.trend_insight(t),
        "month_labels": lambda t, p: sales.month_labels(t),
        "product_codes": lambda t, p: sales.product_codes(t),
        "rfm_inputs": lambda t, p: customers.rfm_inputs(t),
        "top_customers_by_region": lambda t, p: customers.top_customers_by_region(t, p.top_k),
        "churn_candidates": lambda t, p: customers.churn_candidates(t, p.active_year, p.lapsed_year),
        "rfm_scores": lambda t, p: rfm.rfm_scores(t, p.recency_offset_days),
        "rfm_quartile_edges": lambda t, p: rfm.rfm_quartile_edges(t, p.recency_offset_days),
        "rfm_segment_summary": lambda t, p: rfm.rfm_segment_summary(t, p.recency_offset_days),
        "rfm_top_segment": lambda t, p: rfm.rfm_top_segment(t, p.recency_offset_days),
        "signup_cohort_activity": lambda t, p: cohort.signup_cohort_activity(t),
        "purchase_cohort_counts": lambda t, p: cohort.purchase_cohort_counts(t),
        "purchase_cohort_retention": lambda t, p: cohort.purchase_cohort_retention(t),
        "purchase_cohort_matrix": lambda t, p: cohort.purchase_cohort_matrix(t, p.cohort_periods),
        "cohort_heatmap": lambda t, p: cohort.cohort_heatmap(t),
        "retention_curve_head": lambda t, p: cohort.retention_curve_head(t),
        "avg_retention_curve": lambda t, p: cohort.avg_retention_curve(t),
        "retention_m1_m3": lambda t, p: cohort.retention_m1_m3(t),
        "ab_summary": lambda t, p: experiment.ab_summary(t),
        "ab_test_result": lambda t, p: experiment.ab_test_result(t),
        "ab_decision": lambda t, p: experiment.ab_decision(t),
        "ab_arm_intervals": lambda t, p: experiment.ab_arm_intervals(t),
        "ab_projection": lambda t, p: experiment.ab_projection(t),
        "ab_sample_size": lambda t, p: experiment.ab_sample_size(t),
        "dq_table_profile": lambda t, p: quality.dq_table_profile(t),
        "dq_invalid_values": lambda t, p: quality.dq_invalid_values(t),
        "dq_primary_keys": lambda t, p: quality.dq_primary_keys(t),
        "dq_foreign_keys": lambda t, p: quality.dq_foreign_keys(t),
        "sample_customers": lambda t, p: sample_exact_n(
            t.customers.select("customer_id", "region", "acquisition_channel"),
            "customer_id", p.sample_n, p.sample_seed),
        "dashboard_dataset": lambda t, p: report.dashboard_json(t),
        "best_customer_month": lambda t, p: storage.best_customer_month(t),
        "csv_types": lambda t, p: storage.csv_types(t),
        "published_tables": lambda t, p: storage.published_tables(t),
        "dashboard_sections": lambda t, p: report.dashboard_sections(t),
        "customers_by_quarter_region": lambda t, p: cells.customers_by_quarter_region(t),
        "value_quartiles_by_region": lambda t, p: cells.value_quartiles_by_region(t),
        "value_scores_by_region": lambda t, p: cells.value_scores_by_region(t),
        "eda_key_figures": lambda t, p: sales.eda_key_figures(t),
        "kpi_strip": lambda t, p: sales.kpi_strip(t),
        "customers_by_signup": lambda t, p: customers.customers_by_signup(t),
        "customer_codes": lambda t, p: customers.customer_codes(t),
        "ab_assignment": lambda t, p: t.customers.select(
            "customer_id", assign_arm(t.customers.customer_id, p.arm_salt).alias("grp")),
    }


_MODELS: dict[tuple[str, str], tuple[tuple, RetailTables]] = {}


def retail_model(spark: SparkSession, sf_dir: str) -> RetailTables:
    """The retail model over ``sf_dir``, one per session: its DataFrames are
    planned once and the order-level table is computed once, written to the
    shared checkpoint folder and read by every later query. Files that are added to
    the tables, removed or written anew give a new model."""
    key, files = (session_key(spark), sf_dir), fingerprint(spark, sf_dir, list(DRIVER_SCHEMAS))
    if key not in _MODELS or _MODELS[key][0] != files:
        _MODELS[key] = files, retail_from_driver(spark, sf_dir, share_order_level="parquet")
    return _MODELS[key][1]


def release(spark: SparkSession) -> None:
    """Forget this session's shared models and delete the tables written for them."""
    app = session_key(spark)
    for key in [k for k in _MODELS if k[0] == app]:
        _, t = _MODELS.pop(key)
        if "order_level" in t._built:
            t.order_level.unpersist()
    discard(spark)


def _q(plan: Plan) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(plan(retail_model(spark, sf_dir), DRIVER_PARAMS))
    return run


def queries() -> dict[str, Query]:
    """Every plan over the warehouse tables of a folder (spark, sf_dir) -> DataFrame, and the queries on files."""
    return {name: _q(plan) for name, plan in plans().items()} | file_queries()


def file_queries() -> dict[str, Query]:
    """Queries that work on the tables' files rather than on a model."""
    return {
        "order_level_refreshed": lambda spark, sf_dir: present(arrivals.order_level_refreshed(spark, sf_dir)),
    }
