"""Exact money arithmetic and null-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_revenue(quantity: Column | str, price: Column | str) -> Column:
    """quantity x unit price rounded half-up to cents, DECIMAL(12,2).

    Price is DECIMAL(10,4), so the product is exact before the one rounding.
    """
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    p = F.col(price) if isinstance(price, str) else price
    return F.round(q.cast("decimal(10,0)") * p, 2).cast("decimal(12,2)")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (no ANSI divide-by-zero error)."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def round_half_up_int(col: Column) -> Column:
    """Round to a whole number, halves away from zero, as INT (SQL ``::INTEGER``)."""
    return F.round(col, 0).cast("int")
