"""Sources and sinks: raw tables, the retail model adapter, CSV/JSON/table IO."""

from tillsight.sources.model import RetailTables
from tillsight.sources.adapter import retail_from_driver, read_driver_table

__all__ = ["RetailTables", "retail_from_driver", "read_driver_table"]
