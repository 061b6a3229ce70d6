"""Star schema from cleaned sales: dimensions, fact, load checks.

Design notes for scale

* Dimensions are aggregates of the fact lines, so each is one partial + final hash
  aggregate; their size is that of the key domain (hours, products, customers,
  countries), never of the lines.
* Surrogate keys (product, country) are numbered in key order by
  ``ranking.global_row_number``: no single-partition window.
* The customer key is the customer id (guest = -1), so the fact takes it directly
  instead of joining a customer dimension built from the same lines.
* Joins of the fact with a dimension are plain equi-joins; AQE turns them into
  broadcast joins when the measured dimension is below the broadcast threshold and
  keeps a sort-merge join (with skew splitting) otherwise. Only literal lookup tables,
  whose size is fixed in code, are broadcast by hint.
* The existence join with ``dim_date`` is dropped: the date dimension is derived from
  the same lines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.functions import dates as D
from tillspark.operators.ranking import global_row_number
from tillspark.session import written


@dataclass
class Warehouse:
    """Named tables of the star schema (all lazy DataFrames)."""

    sales: DataFrame
    dim_date: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    dim_country: DataFrame
    fact: DataFrame
    forecast_results: DataFrame | None = None
    inventory_risk: DataFrame | None = None

    def fact_dated(self) -> DataFrame:
        """Fact lines with their date attributes (fact x dim_date)."""
        return self.fact.join(self.dim_date, "date_key")

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        """Exact revenue per month (``revenue``), written once: forecasts and reports read it more than once."""
        return written(self.fact_dated().groupBy("year_month").agg(F.sum("total_revenue").alias("revenue")), "monthly")


def dim_date(sales: DataFrame) -> DataFrame:
    """Hour-grain date dimension, ``date_key`` = yyyyMMddHH."""
    hours = sales.select(D.date_key("InvoiceDate").alias("date_key"),
                         F.date_trunc("hour", "InvoiceDate").alias("_ts")).distinct()
    ts = F.col("_ts")
    return hours.select(
        "date_key",
        F.to_date(ts).alias("full_date"),
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        F.month(ts).alias("month"),
        D.month_name(ts).alias("month_name"),
        D.iso_week(ts).alias("week_of_year"),
        F.dayofmonth(ts).alias("day_of_month"),
        D.day_of_week(ts).alias("day_of_week"),
        D.day_name(ts).alias("day_name"),
        F.hour(ts).alias("hour"),
        D.year_month(ts).alias("year_month"),
        D.day_of_week(ts).isin(5, 6).alias("is_weekend"),
    )


def dim_product(sales: DataFrame) -> DataFrame:
    """One row per stock code: most frequent description (lowest on ties), key in code order."""
    counts = sales.groupBy("StockCode", "Description").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct(F.col("Description").isNull().alias("missing"), (-F.col("_n")).alias("n"), F.col("Description"))
    products = counts.groupBy("StockCode").agg(
        F.coalesce(F.min_by("Description", rank), F.lit(schemas.DEFAULT_DESCRIPTION)).alias("description"))
    numbered = global_row_number(products, ["StockCode"], out="product_key")
    return numbered.select(F.col("product_key").cast("bigint"),
                           F.col("StockCode").alias("stock_code"), "description")


def dim_customer(sales: DataFrame) -> DataFrame:
    """Known customers keyed by their id, plus the guest row (-1, -1, false)."""
    spark = sales.sparkSession
    known = (sales.select(F.col("CustomerID").cast("bigint").alias("customer_id"))
             .filter(F.col("customer_id").isNotNull()).distinct()
             .select(F.col("customer_id").alias("customer_key"), "customer_id",
                     F.lit(True).alias("has_account")))
    guest = spark.range(1).select(F.lit(schemas.GUEST_KEY).cast("bigint").alias("customer_key"),
                                  F.lit(schemas.GUEST_KEY).cast("bigint").alias("customer_id"),
                                  F.lit(False).alias("has_account"))
    return known.unionByName(guest)


def region_lookup(spark: SparkSession) -> DataFrame:
    """The fixed country -> region list as a DataFrame."""
    return spark.createDataFrame(schemas.COUNTRY_REGIONS, "country_name string, region string")


def dim_country(sales: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Countries found in the data, region by lookup with default 'Other' (W7, B14).

    Countries come from the data, so no sale is lost to an incomplete lookup list.
    """
    numbered = global_row_number(country_regions(sales, regions), ["country_name"], out="country_key")
    return numbered.select(F.col("country_key").cast("bigint"), "country_name", "region")


def country_regions(sales: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """The countries of the lines with their regions, without keys."""
    countries = sales.select(F.col("Country").alias("country_name")) \
        .filter(F.col("country_name").isNotNull()).distinct()
    if regions is None:
        lookup = F.broadcast(region_lookup(sales.sparkSession))  # fixed 34 rows
    else:
        lookup = regions.select("country_name", "region").dropDuplicates(["country_name"])
    return countries.join(lookup, "country_name", "left").select(
        "country_name", F.coalesce("region", F.lit(schemas.DEFAULT_REGION)).alias("region"))


def fact_sales(sales: DataFrame, products: DataFrame, countries: DataFrame,
               customers: DataFrame | None = None) -> DataFrame:
    """Fact lines with surrogate keys.

    Lines whose product or country is not in its dimension are dropped (inner joins),
    as the loader does; ``fk_orphans`` counts them. Guests get customer key -1. With an
    existing customer dimension (incremental loads) pass ``customers`` and the key is
    looked up by a left join instead.
    """
    lines = sales.select(
        F.col("Invoice").alias("invoice_no"),
        D.date_key("InvoiceDate").alias("date_key"),
        F.col("StockCode").alias("stock_code"),
        F.col("CustomerID").cast("bigint").alias("customer_id"),
        F.col("Country").alias("country_name"),
        F.col("Quantity").alias("quantity"),
        F.col("Price").cast("decimal(10,4)").alias("unit_price"),
        F.col("TotalRevenue").cast("decimal(12,2)").alias("total_revenue"),
    )
    joined = (lines.join(products.select("product_key", "stock_code"), "stock_code")
              .join(countries.select("country_key", "country_name"), "country_name"))
    if customers is None:
        cust_key = F.coalesce(F.col("customer_id"), F.lit(schemas.GUEST_KEY).cast("bigint"))
    else:
        joined = joined.join(customers.filter(F.col("customer_key") != schemas.GUEST_KEY)
                             .select("customer_id", "customer_key"), "customer_id", "left")
        cust_key = F.coalesce(F.col("customer_key"), F.lit(schemas.GUEST_KEY).cast("bigint"))
    return joined.select("invoice_no", "date_key", "product_key", cust_key.alias("customer_key"),
                         "country_key", "quantity", "unit_price", "total_revenue")


def with_sale_id(fact: DataFrame) -> DataFrame:
    """Add ``sale_id`` in (date_key, invoice_no, product_key, ...) order.

    The fact is range-partitioned on that order and sorted within partitions; the id is
    (range index << 33) + position in the partition: unique and increasing in date order,
    with gaps between partitions, like a database sequence. Range bounds are sampled when
    the plan runs, so write the result before reading it twice.
    """
    order = ["date_key", "invoice_no", "product_key", "customer_key", "country_key",
             "quantity", "unit_price", "total_revenue"]
    if "month_key" in fact.columns:  # the same order; the writer of months needs no sort of its own
        order = ["month_key", *order]
    numbered = (fact.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("sale_id", F.monotonically_increasing_id()))
    return numbered.select(F.col("sale_id").cast("bigint"), *fact.columns)


class BuiltWarehouse(Warehouse):
    """A warehouse over cleaned lines whose tables are made when first asked for.

    Numbering keys runs jobs, so a load that stores the lines first (``write_warehouse``) makes
    each dimension once, from the stored lines.
    """

    def __init__(self, sales: DataFrame, regions: DataFrame | None = None, forecast: DataFrame | None = None):
        self.sales, self.regions, self.forecast_results = sales, regions, forecast

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(self.sales)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dim_product(self.sales)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dim_customer(self.sales)

    @cached_property
    def dim_country(self) -> DataFrame:
        return dim_country(self.sales, self.regions)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_sales(self.sales, self.dim_product, self.dim_country)


def build_warehouse(sales: DataFrame, regions: DataFrame | None = None,
                    forecast: DataFrame | None = None) -> Warehouse:
    """All star-schema tables from cleaned sales lines."""
    return BuiltWarehouse(sales, regions, forecast)


def fk_orphans(lines: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """Lines whose product or country lookup fails, counted per foreign key (C4).

    Lines are counted per key first, so only key-sized tables are joined.
    """
    def orphans(column: str, parent: DataFrame, parent_key: str, fk: str) -> DataFrame:
        counts = lines.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        return (counts.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
                .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
                .select(F.lit(fk).alias("fk"), "orphan_rows"))

    return (orphans("StockCode", products, "stock_code", "product_key")
            .unionByName(orphans("Country", countries, "country_name", "country_key")))


def _pick(df: DataFrame, keys: list[str], rank: list[Column], largest: bool) -> DataFrame:
    """One row per key: the smallest (or largest) by ``rank``, then by all columns.

    A grouped min/max over a struct aggregates partially in every map task, so a key
    that holds a large share of the rows is reduced before the shuffle (a window over
    the key would send all of its rows to one task).
    """
    others = [c for c in df.columns if c not in keys]
    agg = F.max if largest else F.min
    best = df.groupBy(*keys).agg(agg(F.struct(*[r.alias(f"_r{i}") for i, r in enumerate(rank)],
                                              *[F.col(c) for c in others])).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in others]).select(*df.columns)


def insert_ignore(existing: DataFrame, new: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Rows of ``existing`` plus rows of ``new`` whose key is not present.

    Duplicate keys inside ``new`` keep one row (the smallest by all columns, so the
    result does not depend on the order of arrival).
    """
    keys = [key] if isinstance(key, str) else list(key)
    first_new = _pick(new, keys, [], largest=False)
    fresh = first_new.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh)


def upsert(existing: DataFrame, new: DataFrame, key: Sequence[str] | str,
           order_by: Sequence[str] | None = None) -> DataFrame:
    """Insert new keys, replace the non-key columns of existing keys.

    Among several new rows with one key the last by ``order_by`` wins (by default the
    largest row, deterministic).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank_cols = list(order_by) if order_by else [c for c in new.columns if c not in keys]
    both = (existing.withColumn("_src", F.lit(0))
            .unionByName(new.select(*existing.columns).withColumn("_src", F.lit(1))))
    return _pick(both, keys, [F.col("_src"), *[F.col(c) for c in rank_cols]], largest=True).drop("_src")


def distinct_on(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """First row per key in the given (ascending) order, like ``DISTINCT ON``."""
    keys = [key] if isinstance(key, str) else list(key)
    return _pick(df, keys, [F.col(c) for c in order], largest=False)


def dq_constraints(w: Warehouse) -> DataFrame:
    """Violation counts of the schema's constraints, one row per check.

    Primary/unique keys by group-having counts on the dimensions; NOT NULL and the CHECK in
    one aggregate over the fact; foreign keys by counting the fact per key first and joining
    those key-sized tables with the parents. All zero on a good load. The fact, read once a
    check, is written once.
    """
    def dup(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
        return (df.groupBy(*cols).count().filter("count > 1")
                .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
                .select(F.lit(table).alias("table_name"), F.lit("unique(" + ",".join(cols) + ")").alias("check_name"),
                        F.col("violations").cast("bigint")))

    fact = written(w.fact, "fact")
    fk_parents = [("date_key", w.dim_date, "date_key"), ("product_key", w.dim_product, "product_key"),
                  ("customer_key", w.dim_customer, "customer_key"), ("country_key", w.dim_country, "country_key")]
    not_null = ["invoice_no", "date_key", "product_key", "customer_key", "country_key", "quantity", "unit_price",
                "total_revenue"]
    def fk(col: str, parent: DataFrame, pcol: str) -> DataFrame:
        used = fact.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        return (used.join(parent.select(F.col(pcol).alias(col)), col, "left_anti")
                .agg(F.lit("fact_sales").alias("table_name"), F.lit(f"fk({col})").alias("check_name"),
                               F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations")))

    counts = fact.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"nn_{c}") for c in not_null],
        F.count_if(~(F.col("quantity") > 0) | ~(F.col("unit_price") > 0)).alias("ck"))
    rows = [(f"not_null({c})", f"nn_{c}") for c in not_null] + [("check(quantity>0 and unit_price>0)", "ck")]
    fact_checks = counts.select(F.explode(F.array(*[
        F.struct(F.lit("fact_sales").alias("table_name"), F.lit(name).alias("check_name"),
                 F.col(c).cast("bigint").alias("violations")) for name, c in rows])).alias("s")).select("s.*")
    checks = [
        dup(w.dim_date, "dim_date", ["date_key"]),
        dup(w.dim_product, "dim_product", ["product_key"]),
        dup(w.dim_product, "dim_product", ["stock_code"]),
        dup(w.dim_customer, "dim_customer", ["customer_id"]),
        dup(w.dim_country, "dim_country", ["country_name"]),
        fact_checks,
        *[fk(*parent) for parent in fk_parents],
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def load_validation(w: Warehouse, extra: dict[str, DataFrame] | None = None) -> DataFrame:
    """Row count of every table, one row per table (D15); a table not loaded counts 0."""
    empty = w.sales.sparkSession.range(0)
    tables = {"staging_sales": w.sales, "fact_sales": w.fact, "dim_date": w.dim_date,
              "dim_product": w.dim_product, "dim_customer": w.dim_customer, "dim_country": w.dim_country,
              "forecast_results": w.forecast_results if w.forecast_results is not None else empty,
              "inventory_risk": w.inventory_risk if w.inventory_risk is not None else empty}
    tables.update(extra or {})
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sanity_monthly(w: Warehouse, n: int = 5) -> DataFrame:
    """Revenue of the first ``n`` months, rounded to whole units."""
    monthly = w.fact_dated().groupBy("year_month").agg(F.sum("total_revenue").alias("_rev"))
    return (monthly.orderBy("year_month").limit(n)
            .select("year_month", F.round("_rev", 0).cast("double").alias("revenue")))


def inventory_risk(w: Warehouse, high: float = schemas.RISK_HIGH, medium: float = schemas.RISK_MEDIUM,
                   forecast_qty: DataFrame | None = None) -> DataFrame:
    """Average monthly quantity per product and its risk level.

    The average covers months with sales only. ``forecast_qty`` (stock_code,
    forecast_qty) fills the forecast column and the stock-out flag (forecast above the
    average); without it they stay NULL / false.
    """
    monthly = (w.fact_dated().groupBy("product_key", "year_month")
               .agg(F.sum("quantity").alias("qty")))
    return risk_of_monthly(monthly, w.dim_product, high, medium, forecast_qty)


def risk_of_monthly(monthly: DataFrame, products: DataFrame, high: float = schemas.RISK_HIGH, medium: float = schemas.RISK_MEDIUM,
                    forecast_qty: DataFrame | None = None) -> DataFrame:
    """``inventory_risk`` from quantities per product and month (``product_key``, ``qty``)."""
    per_product = monthly.groupBy("product_key").agg(F.avg("qty").alias("_avg"))
    risk = (F.when(F.col("_avg") > high, "HIGH").when(F.col("_avg") > medium, "MEDIUM").otherwise("LOW"))
    out = per_product.join(products, "product_key").select(
        "stock_code", "description",
        F.round("_avg", 0).cast("int").alias("avg_monthly_qty"),
        risk.alias("risk_level"))
    if forecast_qty is None:
        out = out.withColumn("forecast_qty", F.lit(None).cast("int"))
    else:
        out = out.join(forecast_qty.select("stock_code", F.round("forecast_qty", 0).cast("int").alias("forecast_qty")),
                       "stock_code", "left")
    flag = F.coalesce(F.col("forecast_qty") > F.col("avg_monthly_qty"), F.lit(False))
    return out.select("stock_code", "description", "avg_monthly_qty", "forecast_qty",
                      flag.alias("stockout_flag"), "risk_level")


TABLE_NAMES = ("dim_date", "dim_product", "dim_customer", "dim_country", "fact_sales")
REPORT_TABLES = ("forecast_results", "inventory_risk")
CURRENT = "_current"


def write_warehouse(w: Warehouse, path: str, with_ids: bool = True,
                    reports: dict[str, Callable[[Warehouse], DataFrame]] | None = None) -> str:
    """Store the star schema, forecast and risk tables under ``path``.

    Each load goes to a folder of its own; a one-row pointer table names the load to read
    and is replaced last. A failed load leaves the former one in use, and a load may read
    what it replaces. The fact is range-partitioned by date (``with_sale_id`` numbers it in
    that order) and partitioned on disk by ``month_key`` = yyyyMM, so date-filtered reports
    prune whole months and a large month is split over tasks. The cleaned sales, read by
    five tables, are written once instead of being cached. ``reports`` makes report tables (name
    of ``REPORT_TABLES`` -> function of a warehouse) from the stored tables, not from the source
    of the lines again. Returns the folder of the load.
    """
    spark = w.sales.sparkSession
    load = f"load-{uuid.uuid4().hex}"
    at = f"{path.rstrip('/')}/{load}"

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")

    sales = store("staging_sales", w.sales)
    days, customers = store("dim_date", dim_date(sales)), store("dim_customer", dim_customer(sales))
    # keys are read back from the written dimensions, not recomputed
    places = dim_country(sales, w.regions) if isinstance(w, BuiltWarehouse) else w.dim_country
    products, countries = store("dim_product", dim_product(sales)), store("dim_country", places)
    fact = fact_sales(sales, products, countries)
    fact = fact.withColumn("month_key", (F.col("date_key") / 10000).cast("int"))
    fact = with_sale_id(fact) if with_ids else fact
    fact.write.partitionBy("month_key").parquet(f"{at}/fact_sales")
    stored = Warehouse(sales, days, products, customers, countries, spark.read.parquet(f"{at}/fact_sales").drop("sale_id"))
    for name in REPORT_TABLES:
        table = reports[name](stored) if reports and name in reports else getattr(w, name)
        if table is not None:
            store(name, table)
    spark.createDataFrame([(load,)], "load string").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{CURRENT}")
    return at


def read_warehouse(spark: SparkSession, path: str) -> Warehouse:
    """The current load written by ``write_warehouse``."""
    at = f"{path.rstrip('/')}/{spark.read.parquet(f'{path.rstrip('/')}/{CURRENT}').first().load}"
    t = {name: spark.read.parquet(f"{at}/{name}") for name in ("staging_sales", *TABLE_NAMES)}
    jpath = spark._jvm.org.apache.hadoop.fs.Path(at)
    stored = {f.getPath().getName() for f in
              jpath.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jpath)}
    reports = {name: spark.read.parquet(f"{at}/{name}") for name in REPORT_TABLES if name in stored}
    fact = t["fact_sales"].drop("sale_id")  # month_key stays: date windows prune on it
    return Warehouse(sales=t["staging_sales"], dim_date=t["dim_date"], dim_product=t["dim_product"],
                     dim_customer=t["dim_customer"], dim_country=t["dim_country"], fact=fact, **reports)
