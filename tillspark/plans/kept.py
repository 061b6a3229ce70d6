"""Reports from the roll-ups that a grown warehouse keeps: no fact line is read.

The results are those of the reports of the same names over the fact.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.functions.money import safe_ratio
from tillspark.operators.bitmaps import counts_of_bits, merged_bits
from tillspark.operators.store import KINDS, KeptWarehouse
from tillspark.operators.warehouse import risk_of_monthly
from tillspark.plans.reports import _as_of, _money, risk_trend


def _year_month(month_key: str) -> Column:
    return F.format_string("%04d-%02d", F.floor(F.col(month_key) / 100), F.col(month_key) % 100)


def _from(df: DataFrame, start: Column) -> DataFrame:
    """Rows of a daily table from ``start`` on; whole months before it are not read."""
    return df.filter((F.col("month_key") >= F.year(start) * 100 + F.month(start)) & (F.col("full_date") >= start))


def _all_customers() -> Column:
    return F.col("customer") + F.col("guest")  # the guest is one customer key


def distinct_counts(w: KeptWarehouse, as_of: _dt.date | str | None = None, days: int = 30) -> DataFrame:
    """Distinct invoices, customers (with the guest) and products per month, over all time and the
    last ``days`` days before ``as_of`` (default: the last sale)."""
    months = merged_bits(w.distinct_bits, ["month_key"])
    recent = _from(w.distinct_bits, F.date_sub(_as_of(w, as_of), days))
    out = counts_of_bits(months, ["month_key"], KINDS).withColumn("period", _year_month("month_key"))
    for period, bits in (("all", months), (f"last_{days}_days", recent)):
        out = out.unionByName(counts_of_bits(bits, [], KINDS).withColumn("period", F.lit(period)), allowMissingColumns=True)
    return out.select("period", F.col("invoice").alias("num_invoices"), _all_customers().alias("num_customers"),
                      F.col("product").alias("num_products"))


def q01_monthly_revenue(w: KeptWarehouse) -> DataFrame:
    sums = w.monthly_product.groupBy("month_key").agg(F.sum("revenue").alias("_rev"), F.sum("units").alias("total_units_sold"))
    counts = counts_of_bits(w.distinct_bits, ["month_key"], KINDS)
    months = w.dim_date.select((F.col("year") * 100 + F.col("month")).alias("month_key"), "year_month", "year", "month", "month_name").distinct()
    return sums.join(counts, "month_key").join(months, "month_key").select(
        "year_month", "year", "month", "month_name", _money("_rev").alias("total_revenue"), "total_units_sold",
        F.col("invoice").alias("num_invoices"), _all_customers().alias("num_customers"), F.col("product").alias("num_products"),
        safe_ratio(_money("_rev"), F.col("invoice")).alias("avg_order_value")).orderBy("year_month")


def q08_monthly_product(w: KeptWarehouse) -> DataFrame:
    return w.monthly_product.join(w.dim_product, "product_key").select(
        _year_month("month_key").alias("year_month"), "stock_code", "description", _money("revenue").alias("revenue"),
        F.col("units").alias("units_sold"), F.col("lines").alias("num_line_items")).orderBy("year_month", F.col("revenue").desc(), "stock_code")


def inventory_risk(w: KeptWarehouse, high: float = schemas.RISK_HIGH, medium: float = schemas.RISK_MEDIUM) -> DataFrame:
    return risk_of_monthly(w.monthly_product.select("product_key", F.col("units").alias("qty")), w.dim_product, high, medium)


def q09_risk_trend(w: KeptWarehouse, high: float = schemas.RISK_HIGH, medium: float = schemas.RISK_MEDIUM,
                   as_of: _dt.date | str | None = None) -> DataFrame:
    recent = _from(w.daily_product, F.add_months(_as_of(w, as_of), -3))
    monthly = recent.groupBy("product_key", "month_key").agg(F.sum("units").alias("qty"))
    return risk_trend(inventory_risk(w, high, medium), monthly, w.dim_product)


def q10_kpis(w: KeptWarehouse, as_of: _dt.date | str | None = None, days: int = 30) -> DataFrame:
    start = F.date_sub(_as_of(w, as_of), days)
    months = merged_bits(w.distinct_bits, ["month_key"])
    total = counts_of_bits(months, [], KINDS).select(F.struct("invoice", "customer", "product")).scalar()
    recent = _from(w.distinct_bits, start)
    revenue = w.daily_product.agg(F.sum("revenue").alias("_rev"),
                                  F.sum(F.when(F.col("full_date") >= start, F.col("revenue"))).alias("_rev30"))
    return revenue.select(
        _money("_rev").alias("total_revenue_all_time"), total.getField("invoice").alias("total_invoices"),
        total.getField("customer").alias("total_customers"), total.getField("product").alias("total_products"),
        F.round(safe_ratio(_money("_rev"), total.getField("invoice")), 2).alias("avg_order_value"),
        _money("_rev30").alias("revenue_last_30d"),
        counts_of_bits(recent, [], KINDS).select("invoice").scalar().alias("invoices_last_30d"))
