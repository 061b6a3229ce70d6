"""Adapters from the driver's TPC-H-like tables to the retail sales model.

* ``sales``        - clean invoice lines (lineitem x orders x customer x nation x part)
* ``dirty_sales``  - the same lines with the faults the cleaning steps remove
* ``event_sales``  - web events as sales lines, for hour and weekday work
* ``country_regions`` - nation -> region lookup

Every adapter is a lazy DataFrame over the given Parquet tables, so Catalyst prunes the
columns each report needs and pushes filters into the scans. The joins are equi-joins
on the TPC-H keys; their strategy (broadcast or sort-merge) is left to AQE, which
measures the real size of each side at run time.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    # Orders meet their customers before the lines do: a customer table too large to be broadcast
    # then costs an exchange of the orders, not one of the lines.
    placed = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, customer.c_nationkey == nation.n_nationkey))
    return (li.join(placed, li.l_orderkey == orders.o_orderkey)
            .join(part, li.l_partkey == part.p_partkey))


def _stock_code(partkey: Column) -> Column:
    return F.lpad(partkey.cast("string"), 5, "0")


def _revenue() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


def _price() -> Column:
    # revenue / quantity, half-up to 4 places. The 6-place intermediate of decimal
    # division cannot create a false tie: with quantity <= 50 a non-tie is at least
    # 1e-6 away from one.
    return (_revenue() / F.col("l_quantity").cast("int")).cast("decimal(10,4)")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sales lines in the raw column layout (Invoice ... Country)."""
    lines = _order_lines(spark, sf_dir)
    return lines.select(
        F.col("l_orderkey").cast("string").alias("Invoice"),
        _stock_code(F.col("l_partkey")).alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        _price().alias("Price"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines with the faults of the raw export, for the cleaning steps.

    cancelled invoices ('C' prefix) for return flag R; guests (no customer) for every
    fifth customer; missing, 'nan', padded upper-case and competing (brand)
    descriptions; postage and too-short stock codes, padded lower-case codes; negative
    quantities and zero prices; padded invoice and country text; exact copies of every
    first order line. Invoice hours run from 8 to 19.
    """
    lines = _order_lines(spark, sf_dir)
    ln, rf, pk = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_partkey")
    invoice = F.when(rf == "R", F.concat(F.lit("C"), F.col("l_orderkey").cast("string"))) \
        .otherwise(F.col("l_orderkey").cast("string"))
    invoice = F.when(ln == 2, F.concat(invoice, F.lit(" "))).otherwise(invoice)
    code = (F.when(pk % 50 == 0, F.lit("POST"))
            .when(pk % 61 == 0, (pk % 1000).cast("string"))
            .when(pk % 7 == 0, F.concat(F.lit("\t"), _stock_code(pk), F.lit("b ")))
            .otherwise(_stock_code(pk)))
    description = (F.when(ln == 7, F.lit(None).cast("string"))
                   .when((ln == 4) & (pk % 11 == 0), F.lit("nan"))
                   .when(ln == 3, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
                   .when(ln == 5, F.col("p_brand"))
                   .otherwise(F.col("p_name")))
    qty = F.col("l_quantity").cast("int")
    quantity = F.when((ln == 6) & (rf == "A"), -qty).otherwise(qty)
    price = F.when((ln == 5) & (rf == "N") & (pk % 3 == 0), F.lit(0).cast("decimal(10,4)")) \
        .otherwise(_price())
    invoice_date = F.expr("timestampadd(HOUR, CAST(l_orderkey % 12 + 8 AS INT), o_orderdate)")
    customer = F.when(F.col("o_custkey") % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey"))
    country = F.when(ln == 2, F.concat(F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    # every first order line appears twice: a generator in the same pass, not a union
    # that would scan and join the tables a second time
    copies = F.explode(F.when(ln == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return lines.select(
        invoice.alias("Invoice"), code.alias("StockCode"), description.alias("Description"),
        quantity.alias("Quantity"), invoice_date.alias("InvoiceDate"), price.alias("Price"),
        customer.alias("CustomerID"), country.alias("Country"), copies.alias("_copy")).drop("_copy")


def event_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events as one-unit sales lines: these carry real hours and weekdays.

    The user is the customer of the same key; the country is that customer's nation
    ('Unspecified' when the user is not a customer).
    """
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ev = (ev.join(customer, ev.user_id == customer.c_custkey, "left")
          .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left"))
    return ev.select(
        F.col("event_id").cast("string").alias("Invoice"),
        F.upper("event_type").alias("StockCode"),
        F.initcap("event_type").alias("Description"),
        F.lit(1).alias("Quantity"),
        F.col("ts").alias("InvoiceDate"),
        F.col("value").cast("decimal(10,4)").alias("Price"),
        F.col("user_id").alias("CustomerID"),
        F.coalesce(F.col("n_name"), F.lit("Unspecified")).alias("Country"),
    )


def country_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country -> region lookup of the test data (nation x region)."""
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("country_name"), F.col("r_name").alias("region"))


def seasonal_naive_forecast(w) -> DataFrame:
    """A ``forecast_results`` table for the test data: same month a year earlier.

    Covers the last 6 months of history and the 6 months after it, so the
    actual-against-forecast report has overlap, actual-only and forecast-only months.
    Bounds are 80 % and 120 % of the forecast. Derived from the warehouse's monthly
    actuals (a months-sized table).
    """
    actual = w.monthly_revenue.withColumnRenamed("revenue", "_rev")
    last = actual.agg(F.max("year_month").alias("_m"))
    start = F.to_date(F.concat(F.col("_m"), F.lit("-01")))
    horizon = last.select(F.explode(F.sequence(F.lit(-5), F.lit(6))).alias("_i"), start.alias("_d")).select(
        F.date_format(F.add_months("_d", F.col("_i")), "yyyy-MM").alias("year_month"),
        F.date_format(F.add_months("_d", F.col("_i") - 12), "yyyy-MM").alias("_src"))
    src = actual.select(F.col("year_month").alias("_src"), "_rev")
    return horizon.join(src, "_src").select(
        "year_month",
        F.col("_rev").cast("decimal(14,2)").alias("forecast_revenue"),
        (F.col("_rev") * F.lit(Decimal("0.8"))).cast("decimal(14,2)").alias("lower_80ci"),
        (F.col("_rev") * F.lit(Decimal("1.2"))).cast("decimal(14,2)").alias("upper_80ci"),
        F.lit("Seasonal naive").alias("model_used"))
