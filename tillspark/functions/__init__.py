"""Column expressions (JVM-side, codegen'd): text, dates, money."""

from tillspark.functions.dates import (date_key, day_name, day_of_week, iso_week, month_name,
                                       month_start, year_month)
from tillspark.functions.money import line_revenue, round_half_up_int, safe_ratio
from tillspark.functions.text import is_missing_text, strip_all, title_case

__all__ = [
    "date_key", "day_name", "day_of_week", "iso_week", "month_name", "month_start", "year_month",
    "line_revenue", "round_half_up_int", "safe_ratio",
    "is_missing_text", "strip_all", "title_case",
]
