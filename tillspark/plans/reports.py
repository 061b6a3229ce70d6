"""Reporting queries over the star schema and the cleaned lines.

Money is summed exactly as DECIMAL and returned as DOUBLE. Ties in top-k and NTILE
orders are broken by the natural key, so results are deterministic. Global windows run
only over aggregated, bounded tables (months, countries); everything over lines or
customers is a keyed aggregate.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.functions.money import safe_ratio
from tillspark.operators.selection import ntiles_by_cuts, quantiles_by_counts
from tillspark.operators.warehouse import Warehouse, inventory_risk
from tillspark.session import written


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _since(w: Warehouse, start: Column) -> DataFrame:
    """Fact lines with their date attributes from ``start`` on.

    A stored fact carries ``month_key`` (yyyyMM, its partition column): a bound on it
    lets the scan skip whole months before the date join.
    """
    fact = w.fact
    if "month_key" in fact.columns:
        fact = fact.filter(F.col("month_key") >= (F.year(start) * 100 + F.month(start)))
    return fact.join(w.dim_date, "date_key").filter(F.col("full_date") >= start)


def _as_of(w: Warehouse, as_of: _dt.date | str | None) -> Column:
    """Reference date: given, or the last sale date (a scalar subquery, run once)."""
    if as_of is None:
        return w.dim_date.agg(F.max("full_date")).scalar()
    return F.lit(as_of).cast("date")


# ---------------------------------------------------------------------------
# Q1-Q10
# ---------------------------------------------------------------------------

def q01_monthly_revenue(w: Warehouse) -> DataFrame:
    """Monthly revenue, units, distinct invoices/customers/products, average order value."""
    f = w.fact_dated()
    agg = f.groupBy("year_month", "year", "month", "month_name").agg(
        F.sum("total_revenue").alias("_rev"),
        F.sum("quantity").alias("total_units_sold"),
        F.count_distinct("invoice_no").alias("num_invoices"),
        F.count_distinct("customer_key").alias("num_customers"),
        F.count_distinct("product_key").alias("num_products"))
    return agg.select(
        "year_month", "year", "month", "month_name",
        _money("_rev").alias("total_revenue"),
        F.col("total_units_sold").cast("bigint"), "num_invoices", "num_customers", "num_products",
        safe_ratio(_money("_rev"), F.col("num_invoices")).alias("avg_order_value"),
    ).orderBy("year_month")


def q02_actual_vs_forecast(w: Warehouse) -> DataFrame:
    """Monthly actuals beside forecasts; months with only a forecast are 'Forecast' rows."""
    actual = w.monthly_revenue.withColumnRenamed("revenue", "_actual")
    fr = w.forecast_results
    if fr is None:
        fr = w.sales.sparkSession.createDataFrame([], schemas.FORECAST_RESULTS)
    joined = actual.join(fr, "year_month", "full_outer")
    return joined.select(
        "year_month",
        _money("_actual").alias("actual_revenue"),
        _money("forecast_revenue").alias("forecast_revenue"),
        _money("lower_80ci").alias("lower_80ci"),
        _money("upper_80ci").alias("upper_80ci"),
        "model_used",
        F.when(F.col("_actual").isNull(), "Forecast").otherwise("Actual").alias("data_type"),
    ).orderBy("year_month")


def q03_yoy_growth(w: Warehouse) -> DataFrame:
    """Revenue per (year, month) against the same month a year earlier.

    The previous year comes from a RANGE frame of exactly one year back within the
    calendar month, so a missing year gives NULL, with no self join.
    """
    monthly = w.fact_dated().groupBy("year", "month").agg(_money(F.sum("total_revenue")).alias("current_revenue"))
    prev_w = Window.partitionBy("month").orderBy("year").rangeBetween(-1, -1)
    prev = F.max("current_revenue").over(prev_w)
    out = monthly.withColumn("prev_year_revenue", prev)
    growth = safe_ratio(F.col("current_revenue") - F.col("prev_year_revenue"), F.col("prev_year_revenue")) * 100
    return out.select("year", "month", "current_revenue", "prev_year_revenue",
                      F.round(growth, 2).alias("yoy_growth_pct")).orderBy("year", "month")


def q04_top_products(w: Warehouse, k: int = 20) -> DataFrame:
    """Top ``k`` products by revenue (ties by stock code)."""
    agg = w.fact.groupBy("product_key").agg(
        F.sum("total_revenue").alias("_rev"),
        F.sum("quantity").cast("bigint").alias("total_units"),
        F.count_distinct("invoice_no").alias("num_orders"),
        F.round(F.avg("unit_price"), 2).cast("double").alias("avg_unit_price"),
        F.count_distinct("customer_key").alias("unique_customers")).join(w.dim_product, "product_key")
    return (agg.orderBy(F.col("_rev").desc(), "stock_code").limit(k)
            .select("stock_code", "description", _money("_rev").alias("total_revenue"), "total_units",
                    "num_orders", "avg_unit_price", "unique_customers"))


def q05_revenue_by_country(w: Warehouse) -> DataFrame:
    """Revenue per country and region with its share of the total.

    The total is a scalar subquery over the per-country table.
    """
    per = w.fact.groupBy("country_key").agg(
        F.sum("total_revenue").alias("_rev"),
        F.sum("quantity").cast("bigint").alias("total_units"),
        F.count_distinct("customer_key").alias("num_customers"),
        F.count_distinct("invoice_no").alias("num_invoices")).join(w.dim_country, "country_key")
    total = per.agg(F.sum("_rev")).scalar()
    pct = F.round(_money("_rev") * 100.0 / total.cast("double"), 2)
    return (per
            .select("country_name", "region", _money("_rev").alias("total_revenue"), "total_units",
                    "num_customers", "num_invoices", pct.alias("revenue_pct"))
            .orderBy(F.col("total_revenue").desc(), "country_name"))


def q06_dow_hour_heatmap(w: Warehouse) -> DataFrame:
    """Revenue, invoices and mean line revenue per weekday and hour."""
    f = w.fact_dated()
    agg = f.groupBy("day_name", "day_of_week", "hour").agg(
        F.sum("total_revenue").alias("_rev"),
        F.count_distinct("invoice_no").alias("num_invoices"),
        F.round(F.avg("total_revenue"), 2).cast("double").alias("avg_line_revenue"))
    return agg.select("day_name", "day_of_week", "hour", _money("_rev").alias("total_revenue"),
                      "num_invoices", "avg_line_revenue").orderBy("day_of_week", "hour")


def rfm_scores(w: Warehouse, k: int = schemas.RFM_TILES, recent_is_high: bool = False) -> DataFrame:
    """Per known customer: last purchase, recency, frequency, monetary and three NTILE scores.

    ``recent_is_high=False`` reproduces the reference: NTILE over recency ascending, so
    the most recent customers score 1. ``True`` gives the usual RFM reading (most recent
    = k). Ties are broken by customer key. The scores are ``ntiles_by_cuts``: no range sort
    and no join of scores, only counts over the written customers.
    """
    base = written(w.fact_dated().filter(F.col("customer_key") != schemas.GUEST_KEY)
            .groupBy("customer_key").agg(
                F.max("full_date").alias("last_purchase_date"),
                F.count_distinct("invoice_no").alias("frequency"),
                F.sum("total_revenue").alias("monetary")), "customers")
    ref = F.lit(base.agg(F.max("last_purchase_date")).first()[0]).cast("date")
    scored = base.withColumn("recency_days", F.datediff(ref, F.col("last_purchase_date")))
    recency = F.col("recency_days")
    return ntiles_by_cuts(scored, "customer_key", {"r_score": -recency if recent_is_high else recency, "f_score": F.col("frequency"),
                                                   "m_score": F.col("monetary") * 100}, k)


def q07_rfm(w: Warehouse, k: int = schemas.RFM_TILES, recent_is_high: bool = False) -> DataFrame:
    """RFM segmentation (reference thresholds: 12, 9, r>=4, f>=4, <=5)."""
    s = rfm_scores(w, k, recent_is_high)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    segment = (F.when(total >= schemas.RFM_CHAMPIONS, "Champions")
               .when(total >= schemas.RFM_LOYAL, "Loyal")
               .when(F.col("r_score") >= schemas.RFM_RECENT, "Recent")
               .when(F.col("f_score") >= schemas.RFM_FREQUENT, "Frequent")
               .when(total <= schemas.RFM_AT_RISK, "At Risk")
               .otherwise("Potential"))
    return s.select(
        "customer_key", "last_purchase_date", "recency_days", "frequency",
        F.round(_money("monetary"), 2).alias("monetary"),
        "r_score", "f_score", "m_score",
        F.round(total / 3.0, 1).cast("double").alias("rfm_score"),
        segment.alias("segment"),
    ).orderBy(F.col("rfm_score").desc(), "customer_key")


def rfm_segment_counts(w: Warehouse, **kw) -> DataFrame:
    """Customers per RFM segment."""
    return q07_rfm(w, **kw).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))


def q08_monthly_product(w: Warehouse) -> DataFrame:
    """Revenue, units and line count per month and product."""
    agg = w.fact_dated().groupBy("year_month", "product_key").agg(
        F.sum("total_revenue").alias("_rev"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.count("invoice_no").alias("num_line_items")).join(w.dim_product, "product_key")
    return agg.select("year_month", "stock_code", "description", _money("_rev").alias("revenue"),
                      "units_sold", "num_line_items").orderBy("year_month", F.col("revenue").desc(), "stock_code")


def q09_risk_trend(w: Warehouse, high: float = schemas.RISK_HIGH, medium: float = schemas.RISK_MEDIUM,
                   as_of: _dt.date | str | None = None, forecast_qty: DataFrame | None = None) -> DataFrame:
    """Inventory risk with the demand trend of the last three months before ``as_of``.

    ``as_of`` defaults to the last sale date (``CURRENT_DATE`` on historic data would
    leave the window empty). The date filter sits on the fact x date join and prunes
    the scan of the date dimension.
    """
    ir = inventory_risk(w, high, medium, forecast_qty)
    ref = _as_of(w, as_of)
    recent_lines = _since(w, F.add_months(ref, -3))
    monthly = recent_lines.groupBy("product_key", "year_month").agg(F.sum("quantity").alias("qty"))
    return risk_trend(ir, monthly, w.dim_product)


def risk_trend(ir: DataFrame, recent_monthly: DataFrame, products: DataFrame) -> DataFrame:
    """Inventory risk ``ir`` with the trend of ``recent_monthly`` (``product_key``, ``qty`` per month)."""
    recent = (recent_monthly.join(products, "product_key").groupBy("stock_code")
              .agg(F.round(F.avg("qty"), 0).alias("last_3m_avg_qty")))
    out = ir.join(recent, "stock_code", "left")
    trend = (F.when(F.col("last_3m_avg_qty") > F.col("avg_monthly_qty") * F.lit(schemas.TREND_RISING), "DEMAND RISING")
             .when(F.col("last_3m_avg_qty") < F.col("avg_monthly_qty") * F.lit(schemas.TREND_FALLING), "DEMAND FALLING")
             .otherwise("STABLE"))
    rank = F.when(F.col("risk_level") == "HIGH", 1).when(F.col("risk_level") == "MEDIUM", 2).otherwise(3)
    return out.select("stock_code", "description", "avg_monthly_qty", "forecast_qty", "stockout_flag",
                      "risk_level", F.col("last_3m_avg_qty").cast("double"), trend.alias("demand_trend")) \
        .orderBy(rank, F.col("avg_monthly_qty").desc(), "stock_code")


def q10_kpis(w: Warehouse, as_of: _dt.date | str | None = None, days: int = 30) -> DataFrame:
    """One KPI row: all-time totals and the last ``days`` days before ``as_of``."""
    ref = _as_of(w, as_of)
    f = w.fact_dated()
    recent = F.col("full_date") >= F.date_sub(ref, days)
    known = F.col("customer_key") != schemas.GUEST_KEY
    agg = f.agg(
        F.sum("total_revenue").alias("_rev"),
        F.count_distinct("invoice_no").alias("total_invoices"),
        F.count_distinct(F.when(known, F.col("customer_key"))).alias("total_customers"),
        F.count_distinct("product_key").alias("total_products"),
        F.sum(F.when(recent, F.col("total_revenue"))).alias("_rev30"),
        F.count_distinct(F.when(recent, F.col("invoice_no"))).alias("invoices_last_30d"))
    return agg.select(
        _money("_rev").alias("total_revenue_all_time"), "total_invoices", "total_customers", "total_products",
        F.round(safe_ratio(_money("_rev"), F.col("total_invoices")), 2).alias("avg_order_value"),
        _money("_rev30").alias("revenue_last_30d"), "invoices_last_30d")


# ---------------------------------------------------------------------------
# Tables of the cleaning step (W2, W3) and EDA
# ---------------------------------------------------------------------------

def monthly_sales(cleaned: DataFrame) -> DataFrame:
    """Revenue, quantity and distinct invoices/customers/products per month."""
    agg = cleaned.groupBy("YearMonth").agg(
        F.sum("TotalRevenue").alias("_rev"),
        F.sum("Quantity").cast("bigint").alias("TotalQuantity"),
        F.count_distinct("Invoice").alias("NumInvoices"),
        F.count_distinct("CustomerID").alias("NumCustomers"),
        F.count_distinct("StockCode").alias("NumProducts"))
    return agg.select("YearMonth", _money("_rev").alias("TotalRevenue"), "TotalQuantity", "NumInvoices",
                      "NumCustomers", "NumProducts").orderBy("YearMonth")


def monthly_by_product(cleaned: DataFrame) -> DataFrame:
    """Revenue and quantity per month, stock code and description."""
    agg = cleaned.groupBy("YearMonth", "StockCode", "Description").agg(
        F.sum("TotalRevenue").alias("_rev"), F.sum("Quantity").cast("bigint").alias("Qty"))
    return agg.select("YearMonth", "StockCode", "Description", _money("_rev").alias("Revenue"), "Qty") \
        .orderBy("StockCode", "YearMonth")


_WEEK = [(0, "Monday"), (1, "Tuesday"), (2, "Wednesday"), (3, "Thursday"), (4, "Friday"),
         (5, "Saturday"), (6, "Sunday")]


def revenue_by_dow(cleaned: DataFrame, days: list[tuple[int, str]] | None = None) -> DataFrame:
    """Revenue per weekday on a fixed calendar; days without sales are NULL.

    The calendar (at most seven rows) is broadcast to the seven-row aggregate.
    """
    spark = cleaned.sparkSession
    cal = spark.createDataFrame(days or _WEEK, "day_of_week int, day_name string")
    per_day = cleaned.groupBy(F.col("DayOfWeekName").alias("day_name")).agg(F.sum("TotalRevenue").alias("_rev"))
    return (F.broadcast(cal).join(per_day, "day_name", "left")
            .select("day_of_week", "day_name", _money("_rev").alias("total_revenue")).orderBy("day_of_week"))


def revenue_by_hour(cleaned: DataFrame) -> DataFrame:
    """Revenue per hour of day."""
    return (cleaned.groupBy(F.col("Hour").alias("hour")).agg(_money(F.sum("TotalRevenue")).alias("total_revenue"))
            .orderBy("hour"))


def top_products(cleaned: DataFrame, k: int = 15) -> DataFrame:
    """Top ``k`` (stock code, description) by revenue (X2); ties by code, description."""
    agg = cleaned.groupBy("StockCode", "Description").agg(F.sum("TotalRevenue").alias("_rev"))
    return (agg.orderBy(F.col("_rev").desc(), "StockCode", "Description").limit(k)
            .select("StockCode", "Description", _money("_rev").alias("TotalRevenue")))


def top_countries(cleaned: DataFrame, k: int = 10, exclude: str = "United Kingdom") -> DataFrame:
    """Top ``k`` countries by revenue, one country left out."""
    agg = cleaned.filter(F.col("Country") != exclude).groupBy("Country").agg(F.sum("TotalRevenue").alias("_rev"))
    return (agg.orderBy(F.col("_rev").desc(), "Country").limit(k)
            .select("Country", _money("_rev").alias("TotalRevenue")))


def eda_summary(cleaned: DataFrame) -> DataFrame:
    """Totals, mean month, peak and lowest month, distinct counts: one row.

    Peak/lowest use ``max_by``/``min_by`` over the monthly table; ties go to the
    earlier month.
    """
    monthly = cleaned.groupBy("YearMonth").agg(F.sum("TotalRevenue").alias("_m"))
    months = monthly.select(F.struct(
        _money(F.sum("_m")).alias("sum_m"), F.count(F.lit(1)).alias("n_m"),
        F.min_by("YearMonth", F.struct((-F.col("_m")).alias("a"), F.col("YearMonth").alias("b"))).alias("peak"),
        F.min_by("YearMonth", F.struct(F.col("_m").alias("a"), F.col("YearMonth").alias("b"))).alias("low"))
    ).scalar()
    totals = cleaned.agg(
        _money(F.sum("TotalRevenue")).alias("total_revenue"),
        F.count_distinct("StockCode").alias("unique_products"),
        F.count_distinct("CustomerID").alias("unique_customers"),
        F.count_distinct("Country").alias("countries"))
    return totals.select(
        "total_revenue", (months.getField("sum_m") / months.getField("n_m")).alias("avg_monthly_revenue"),
        months.getField("peak").alias("peak_month"), months.getField("low").alias("lowest_month"),
        "unique_products", "unique_customers", "countries")


def dataset_summary(cleaned: DataFrame) -> DataFrame:
    """Row count, date range, distinct counts and revenue: one row."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows"),
        F.to_date(F.min("InvoiceDate")).alias("first_date"),
        F.to_date(F.max("InvoiceDate")).alias("last_date"),
        F.count_distinct("CustomerID").alias("customers"),
        F.count_distinct("StockCode").alias("products"),
        F.count_distinct("Country").alias("countries"),
        _money(F.sum("TotalRevenue")).alias("revenue"))


def boxplot_by_month(cleaned: DataFrame, value: str = "TotalRevenue") -> DataFrame:
    """Box-plot data per calendar month: quartiles, whiskers, flier count.

    Quartiles are exact (linear interpolation) and come from ``quantiles_by_counts``: counts
    per bucket of cents, no shuffle of values. Whiskers are the extreme values within 1.5 IQR,
    found after a join with the (at most twelve-row) quartile table.
    """
    v = F.col(value).cast("double")
    q = quantiles_by_counts(cleaned, "Month", F.col(value) * 100, [0.25, 0.5, 0.75], 100.0)
    q = q.select("Month", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    joined = cleaned.select("Month", v.alias("_v")).join(F.broadcast(q), "Month")
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    agg = joined.groupBy("Month", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"),
        F.count(F.lit(1)).alias("lines"))
    r6 = lambda c: F.round(F.col(c), 6).alias(c)
    return agg.select(F.col("Month").alias("month"), r6("q1"), r6("median"), r6("q3"),
                      r6("whisker_low"), r6("whisker_high"), "fliers", "lines").orderBy("month")
