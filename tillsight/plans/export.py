"""Write the analysis outputs as files: the shared order-level table, RFM
segments and summary, the cohort retention matrix, the A/B result and the
dashboard document. Every writer emits a folder of part files (no single-task
output)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.plans import cohort, experiment, report, rfm
from tillsight.plans.present import present
from tillsight.sources.files import write_csv, write_order_level
from tillsight.sources.model import RetailTables


def cohort_retention_wide(t: RetailTables) -> DataFrame:
    """cohort_month x every period (columns "0", "1", ...), NULL for no activity.
    The period list is found by Spark (bounded by the months spanned)."""
    ret = cohort.purchase_cohort_retention(t)
    return ret.groupBy("cohort_month").pivot("period").agg(F.first("retention")).orderBy("cohort_month")


def export_reports(t: RetailTables, out_dir: str, offset_days: int = 1) -> dict[str, str]:
    written = {}

    def out(name: str) -> str:
        written[name] = os.path.join(out_dir, name)
        return written[name]

    write_order_level(t.order_level, out("order_level"))
    write_csv(present(t.order_level), out("order_level_clean.csv"))
    write_csv(present(rfm.rfm_scores(t, offset_days)), out("rfm_segments.csv"))
    write_csv(present(rfm.rfm_segment_summary(t, offset_days)), out("rfm_segment_summary.csv"))
    write_csv(present(cohort_retention_wide(t)), out("cohort_retention.csv"))
    write_csv(present(experiment.ab_test_result(t)), out("ab_test_results.csv"))
    report.dashboard_json(t).write.mode("overwrite").text(out("data.json"))
    return written
