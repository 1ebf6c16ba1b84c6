"""Text helpers: product codes, zero-padded ids, number formats for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_code(category: Column, product_id: Column) -> Column:
    """``UPPER(first 4 letters of category)-last 4 characters of the id``, e.g. ``ELEC-0001``; shorter ids are padded."""
    return F.concat(F.upper(F.substring(category, 1, 4)), F.lit("-"), F.lpad(F.right(product_id.cast("string"), F.lit(4)), 4, "0"))


def padded_id(prefix: str, n: Column, width: int) -> Column:
    """``CUST00042`` style ids."""
    return F.format_string(f"{prefix}%0{width}d", n.cast("long"))


def percent_text(ratio: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(ratio * F.lit(100.0), digits), F.lit("%"))


def thousands_text(amount: Column) -> Column:
    """``$123K`` style label."""
    return F.concat(F.lit("$"), F.format_number(amount / F.lit(1000.0), 0), F.lit("K"))
