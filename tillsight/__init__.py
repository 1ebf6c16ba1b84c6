"""tillsight: retail order analytics as Spark DataFrame plans.

Layout:
  sources/    readers, writers and the adapter that maps raw tables onto the
              retail model (customers, products, orders, order_items, campaign)
  functions/  Column-level helpers (dates, rounding, statistics, text)
  operators/  reusable DataFrame -> DataFrame operators (ranks, quantiles,
              gap filling, shares, data quality, sampling)
  plans/      the business queries built from the pieces above
  streaming/  incremental refresh of the monthly revenue series

Typical use:
    from tillsight import build_session, read_retail_csv, plans, Params
    spark = build_session()
    t = read_retail_csv(spark, "data/")
    plans()["rfm_segment_summary"](t, Params()).show()
"""

from tillsight.plans.registry import DRIVER_PARAMS, Params, plans, queries
from tillsight.session import build_session, ensure_checkpoint_dir
from tillsight.sources.adapter import retail_from_driver
from tillsight.sources.files import read_retail_csv
from tillsight.sources.model import RetailTables

__all__ = ["build_session", "ensure_checkpoint_dir", "retail_from_driver", "read_retail_csv", "RetailTables",
           "plans", "queries", "Params", "DRIVER_PARAMS"]
