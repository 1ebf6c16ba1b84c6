"""Incremental refresh of the monthly revenue series with Structured Streaming."""

from tillsight.streaming.monthly import ORDER_LEVEL_SCHEMA, monthly_revenue_stream

__all__ = ["ORDER_LEVEL_SCHEMA", "monthly_revenue_stream"]
