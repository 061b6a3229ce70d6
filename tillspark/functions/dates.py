"""Calendar parts with the conventions of the sales model (Monday = 0, ISO weeks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(ts: Column | str) -> Column:
    """Hour-grain key yyyyMMddHH as INT (fits until the year 2147)."""
    return F.date_format(_c(ts), "yyyyMMddHH").cast("int")


def year_month(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")


def month_start(ts: Column | str) -> Column:
    return F.trunc(F.to_date(_c(ts)), "MM")


def day_of_week(ts: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(ts))


def day_name(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "EEEE")


def month_name(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "MMMM")


def iso_week(ts: Column | str) -> Column:
    return F.weekofyear(_c(ts))
