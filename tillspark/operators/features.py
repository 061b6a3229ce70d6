"""Derived columns of a cleaned sales line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.functions import dates as D
from tillspark.functions.money import line_revenue

CLEANED_ORDER = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
                 "CustomerID", "Country", "IsCancelled", "HasCustomerID", "TotalRevenue", "Year",
                 "Month", "YearMonth", "DayOfWeek", "DayOfWeekName", "Hour", "Quarter", "WeekOfYear"]


def add_features(df: DataFrame) -> DataFrame:
    """Presence flag, exact revenue and calendar parts, all in one projection."""
    ts = F.col("InvoiceDate")
    cols = {
        "HasCustomerID": F.col("CustomerID").isNotNull(),
        "TotalRevenue": line_revenue("Quantity", "Price"),
        "Year": F.year(ts),
        "Month": F.month(ts),
        "YearMonth": D.year_month(ts),
        "DayOfWeek": D.day_of_week(ts),
        "DayOfWeekName": D.day_name(ts),
        "Hour": F.hour(ts),
        "Quarter": F.quarter(ts),
        "WeekOfYear": D.iso_week(ts),
    }
    if "IsCancelled" not in df.columns:
        cols = {"IsCancelled": F.col("Invoice").startswith("C"), **cols}
    out = df.withColumns(cols)
    extra = [c for c in out.columns if c not in CLEANED_ORDER]
    return out.select(*[c for c in CLEANED_ORDER if c in out.columns], *extra)
