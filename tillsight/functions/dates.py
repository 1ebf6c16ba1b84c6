"""Calendar helpers: month keys, month starts, month arithmetic, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(d: Column) -> Column:
    """``YYYY-MM`` text; text order equals time order."""
    return F.date_format(d, "yyyy-MM")


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_index(d: Column) -> Column:
    """Months since year 0: 12 * year + month. Differences are calendar-month gaps."""
    return F.year(d) * 12 + F.month(d)


def months_between_calendar(later: Column, earlier: Column) -> Column:
    """12 * (year difference) + (month difference), ignoring days."""
    return month_index(later) - month_index(earlier)


def month_label(d: Column) -> Column:
    """``Jan 2024`` (chart labels)."""
    return F.date_format(d, "MMM yyyy")


def month_label_short(d: Column) -> Column:
    """``Jan 24`` (heat-map row labels)."""
    return F.date_format(d, "MMM yy")


def year_range(d: Column, year: int) -> Column:
    """``year(d) = year`` written as a range so Parquet can prune on it."""
    return (d >= F.lit(f"{year:04d}-01-01").cast("date")) & (d < F.lit(f"{year + 1:04d}-01-01").cast("date"))


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")
