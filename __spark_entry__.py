"""

Every query reads the driver tables under ``sf_dir`` through the adapters of
``tillspark.sources.testdata`` and runs over all of their rows. Money columns are
returned as DOUBLE (exact DECIMAL sums, cast at the end) so that both engines hash the
same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark import schemas
from tillspark.functions.text import strip_all
from tillspark.operators import catalog as CT
from tillspark.operators import cleaning as C
from tillspark.operators import warehouse as WH
from tillspark.operators.features import add_features
from tillspark.operators.lookup import fact_by_lookup
from tillspark.operators.quantiles import exact_quantiles
from tillspark.operators.ranking import scalable_ntile
from tillspark.operators.store import LINE, Store
from tillspark.plans import kept as K
from tillspark.plans import forecasting as FC
from tillspark.plans import reports as R
from tillspark.sources import audit, files
from tillspark.sources import testdata as TD
from tillspark.session import shared_path, written

FLAGSHIP_SF = "/root/testdata/sf0.001"

# Thresholds for the risk keys: at test scale a part sells ~30 units a month, so the
# default 1000/300 would put every part in LOW.
RISK_HIGH_TEST, RISK_MEDIUM_TEST = 35, 30


def _dbl(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (exact values, engine-neutral hashing)."""
    return df.select([F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                      else F.col(f.name) for f in df.schema.fields])


def sales_warehouse(spark: SparkSession, sf: str) -> WH.Warehouse:
    return WH.build_warehouse(add_features(TD.sales(spark, sf)), TD.country_regions(spark, sf))


def _warehouse_once(spark, sf, forecast=False) -> WH.Warehouse:
    """The star schema over lines that are joined once and written, for queries that read most of its tables."""
    lines = written(add_features(TD.sales(spark, sf)).select(*LINE), "lines")
    w = WH.build_warehouse(lines, TD.country_regions(spark, sf))
    if forecast:
        w.forecast_results = TD.seasonal_naive_forecast(w)
    return w


def events_warehouse(spark: SparkSession, sf: str) -> WH.Warehouse:
    return WH.build_warehouse(add_features(TD.event_sales(spark, sf)), TD.country_regions(spark, sf))


def _normalized(spark, sf):
    return C.normalize_text(TD.dirty_sales(spark, sf))


def _valid(spark, sf):
    df = C.drop_duplicate_rows(_normalized(spark, sf))
    df, _ = C.split_cancellations(df)
    return C.filter_invalid(df)


def _clean_dirty(spark, sf):
    return C.clean_sales(TD.dirty_sales(spark, sf))


def _sales_cleaned(spark, sf):
    return add_features(TD.sales(spark, sf))


def _events_cleaned(spark, sf):
    return add_features(TD.event_sales(spark, sf))


def _split(spark, sf):
    sales, cancelled = C.split_cancellations(C.drop_duplicate_rows(_normalized(spark, sf)))
    both = sales.unionByName(cancelled)
    return both.groupBy("IsCancelled").agg(F.count(F.lit(1)).alias("lines"),
                                           F.sum("Quantity").cast("bigint").alias("quantity"))


def _fill(spark, sf):
    filled = C.fill_by_group_mode(_valid(spark, sf))
    return filled.groupBy("StockCode", "Description").agg(F.count(F.lit(1)).alias("lines"))


def _loads(spark, sf):
    cleaned = _clean_dirty(spark, sf)
    early = F.col("InvoiceDate") < F.lit("1998-01-01").cast("timestamp_ntz")
    def modes(df):
        return C.group_mode(df, "StockCode", "Description").select(
            F.col("StockCode").alias("stock_code"), F.col("_mode_Description").alias("description"))
    return modes(cleaned.filter(early)), modes(cleaned.filter(~early))


def _insert_ignore(spark, sf):
    existing, incoming = _loads(spark, sf)
    return WH.insert_ignore(existing, incoming, "stock_code")


def _upsert(spark, sf):
    existing, incoming = _loads(spark, sf)
    return WH.upsert(existing, incoming, "stock_code")


def _fk_orphans(spark, sf):
    cleaned = _clean_dirty(spark, sf)
    products = WH.dim_product(cleaned)
    countries = WH.dim_country(cleaned, TD.country_regions(spark, sf))
    return WH.fk_orphans(_normalized(spark, sf), products, countries)


def _coerce(spark, sf):
    dirty = TD.dirty_sales(spark, sf)
    return (files.coerce_numeric(dirty.select("Invoice", F.col("Invoice").alias("invoice_number")),
                                 ["invoice_number"])
            .groupBy("Invoice", "invoice_number").agg(F.count(F.lit(1)).alias("lines")))


def _load_merge(spark, sf):
    paths = []
    for part in (TD.sales(spark, sf), TD.event_sales(spark, sf)):  # two raw files, as text
        paths.append(shared_path(spark, "raw-csv"))
        part.select(*schemas.RAW_COLUMNS).write.option("header", True).csv(paths[-1])
    merged = files.load_raw(spark, paths, on_bad="raise")
    return merged.groupBy("Country").agg(F.count(F.lit(1)).alias("lines"),
                                         F.sum("Quantity").cast("bigint").alias("quantity"),
                                         F.sum("Price").cast("double").alias("price_sum"))


def _audit(spark, sf) -> audit.LoadAudit:
    """The dirty lines as CSV, some fields with text that is not of their type, loaded with an audit."""
    dirty, path = TD.dirty_sales(spark, sf), shared_path(spark, "dirty-csv")
    ends = lambda digits: strip_all(F.col("Invoice")).endswith(digits)
    text = dirty.select([F.col(c).cast("string") for c in schemas.RAW_COLUMNS]).withColumns({
        "Quantity": F.when(ends("13"), F.concat("Quantity", F.lit(" pcs"))).otherwise(F.col("Quantity")),
        "Price": F.when(ends("77"), F.lit("n/a")).otherwise(F.col("Price")),
        "CustomerID": F.when(ends("99"), F.lit("12a")).otherwise(F.col("CustomerID"))})
    text.write.option("header", True).csv(path)
    return audit.audited_load(spark, path, shared_path(spark, "audited"))


def _load_rejects(spark, sf):
    return (_audit(spark, sf).rejects_by_rule().groupBy("rule", F.upper(strip_all(F.col("StockCode"))).alias("stock_code"))
            .agg(F.count(F.lit(1)).alias("lines")))


def _load_accepted(spark, sf):
    return (_audit(spark, sf).accepted.groupBy(strip_all(F.col("Country")).alias("country"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("Quantity").cast("bigint").alias("quantity"), F.sum("Price").cast("double").alias("price_sum")))


def _csv_by_name(spark, sf):
    """Sales written as CSV with a header, columns reversed and one more, and read by name."""
    path = shared_path(spark, "by-name")
    files.write_table(TD.sales(spark, sf).select(F.lit("x").alias("more"), *schemas.RAW_COLUMNS[::-1]), path, fmt="csv")
    back = files.read_csv(spark, path, schemas.RAW_SALES)
    return back.groupBy("Country", F.to_date("InvoiceDate").alias("day")).agg(
        F.count("Invoice").alias("lines"), F.sum("Quantity").cast("bigint").alias("quantity"), F.sum("Price").cast("double").alias("price_sum"),
        F.max("CustomerID").alias("last_customer"), F.min("Description").alias("first_name"))


def _append_parts(spark, sf):
    """Three appends to one table, with files of at most 5,000 rows."""
    path, lines = shared_path(spark, "appended"), TD.sales(spark, sf)
    for part in range(3):
        files.write_table(lines.filter(F.month("InvoiceDate") % 3 == part), path, mode="append", max_records_per_file=5_000)
    return spark.read.parquet(path).groupBy("StockCode").agg(F.count(F.lit(1)).alias("lines"), F.sum("Quantity").cast("bigint").alias("quantity"))


def _forecast_file(spark, sf):
    """A forecast written as the file of the modelling step and loaded; a missing file adds nothing."""
    path = shared_path(spark, "forecast-csv")
    named = {v: k for k, v in schemas.FORECAST_COLUMN_NAMES.items()}
    files.write_table(_warehouse_once(spark, sf, forecast=True).forecast_results.withColumnsRenamed(named), path, fmt="csv")
    return _dbl(files.load_forecast(spark, path).unionByName(files.load_forecast(spark, path + "-missing")))


def _catalog(spark) -> str:
    name = f"till_{uuid.uuid4().hex}"
    CT.create_tables(spark, name, shared_path(spark, name))
    return name


def _default_columns(spark, sf):
    """Dimensions inserted without the columns that have a default."""
    db, w = _catalog(spark), sales_warehouse(spark, sf)
    CT.insert_rows(db, "dim_product", w.dim_product.select("product_key", "stock_code"))
    CT.insert_rows(db, "dim_customer", w.dim_customer.select("customer_id", "customer_key"))
    CT.insert_rows(db, "dim_country", w.dim_country.select("country_key", "country_name"))
    parts = [spark.table(f"{db}.{t}").groupBy(F.col(c).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("row_count"), (F.count(stamp) if stamp else F.lit(0).cast("bigint")).alias("stamped"))
        .select(F.lit(t).alias("table_name"), "value", "row_count", "stamped")
        for t, c, stamp in (("dim_product", "description", "created_at"), ("dim_customer", "has_account", "created_at"), ("dim_country", "region", None))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _catalog_constraints(spark, sf):
    """Violations of every constraint of the catalog tables after a load of the grown warehouse."""
    db, w = _catalog(spark), _kept(spark, sf)
    w.forecast_results = TD.seasonal_naive_forecast(w)
    w.inventory_risk = K.inventory_risk(w, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST)
    CT.load_warehouse(w, db)
    return CT.violations(spark, db)


def _distinct_on(spark, sf):
    cleaned = _sales_cleaned(spark, sf)
    return WH.distinct_on(cleaned, "StockCode", ["InvoiceDate", "Invoice"]) \
        .select("StockCode", "Description", "InvoiceDate", "Invoice")


def _ntile(spark, sf):
    w = sales_warehouse(spark, sf)
    per_invoice = w.fact.groupBy("invoice_no").agg(F.sum("total_revenue").cast("double").alias("invoice_revenue"))
    return scalable_ntile(per_invoice, 7, ["invoice_revenue", "invoice_no"], out="tile")


def _fact(spark, sf):
    return _dbl(sales_warehouse(spark, sf).fact)


def _histories(spark, sf):
    """The lines of the last customer, the first product and the last invoice by name."""
    store = _store(spark, sf)
    w = store.read()
    customer = w.dim_customer.agg(F.max("customer_id")).first()[0]
    product, invoice = w.dim_product.agg(F.min("stock_code")).first()[0], w.dim_invoice.agg(F.max("invoice_no")).first()[0]
    parts = [lines.withColumn("asked", F.lit(asked)) for asked, lines in (
        ("customer", store.lines_of(customer_id=customer)), ("product", store.lines_of(stock_code=product)),
        ("invoice", store.lines_of(invoice_no=invoice)))]
    lines = parts[0].unionByName(parts[1]).unionByName(parts[2]).join(w.dim_product, "product_key")
    return _dbl(lines.select("asked", "invoice_no", "date_key", "stock_code", "description", "customer_key", "quantity", "total_revenue"))


def _fact_by_lookup(spark, sf):
    """The fact with keys looked up skew-proof from an existing customer dimension, without
    the customers of every fourth id: their lines fall to the guest, as do lines without one."""
    w = sales_warehouse(spark, sf)
    some = w.dim_customer.filter(F.col("customer_id") % 4 != 0)
    return _dbl(fact_by_lookup(w.sales, w.dim_product, w.dim_country, some))


def _load_validation(spark, sf):
    w = _warehouse_once(spark, sf, forecast=True)
    w.inventory_risk = WH.inventory_risk(w, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST)
    return WH.load_validation(w)


def _llm():
    """The training-data queries, or None where that subpackage has been taken out."""
    try:
        from tillspark.llm import entry as llm
        llm.queries()
    except ModuleNotFoundError as e:
        if e.name not in ("tillspark.llm", "tillspark.llm.entry", "corpus_pipeline"):
            raise
        return None
    return llm


def _stored(spark, sf) -> WH.Warehouse:
    """The star schema with its report tables, written and read back."""
    w = WH.build_warehouse(_sales_cleaned(spark, sf), TD.country_regions(spark, sf))
    path = shared_path(spark, "warehouse")
    WH.write_warehouse(w, path, reports={
        "forecast_results": TD.seasonal_naive_forecast,
        "inventory_risk": lambda stored: WH.inventory_risk(stored, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST)})
    return WH.read_warehouse(spark, path)


# The grown warehouse: two loads that share half a year of lines.
FIRST_BEFORE, SECOND_FROM = "1995-07-01", "1995-01-01"
_STORES: dict = {}


def _store(spark, sf) -> Store:
    """Built once per session and table folder from two overlapping loads."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        store, regions = Store(spark, shared_path(spark, "store")), TD.country_regions(spark, sf)
        lines = add_features(TD.sales(spark, sf))
        store.load(lines.filter(F.col("InvoiceDate") < F.lit(FIRST_BEFORE).cast("timestamp_ntz")), regions)
        store.load(lines.filter(F.col("InvoiceDate") >= F.lit(SECOND_FROM).cast("timestamp_ntz")), regions)
        _STORES[key] = store
    return _STORES[key]


def _kept(spark, sf):
    return _store(spark, sf).read()


def _incremental_load(spark, sf):
    """Fact lines of both loads with their ids and keys, looked up again by name."""
    w = _kept(spark, sf)
    return _dbl(w.fact.join(w.dim_product, "product_key").join(w.dim_country, "country_key").select(
        "sale_id", "invoice_no", "date_key", "product_key", "stock_code", "customer_key", "country_key", "country_name",
        "quantity", "unit_price", "total_revenue"))


def _with(wh, fn, **kw):
    return lambda spark, sf: fn(wh(spark, sf), **kw)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # reports over the star schema
        "q01_monthly_revenue": _with(sales_warehouse, R.q01_monthly_revenue),
        "q02_actual_vs_forecast": _with(lambda s, sf: _warehouse_once(s, sf, forecast=True), R.q02_actual_vs_forecast),
        "q03_yoy_growth": _with(sales_warehouse, R.q03_yoy_growth),
        "q04_top_products": _with(sales_warehouse, R.q04_top_products),
        "q05_revenue_by_country": _with(sales_warehouse, R.q05_revenue_by_country),
        "q06_dow_hour_heatmap": _with(events_warehouse, R.q06_dow_hour_heatmap),
        "q07_rfm": _with(sales_warehouse, R.q07_rfm),
        "rfm_by_cuts": _with(sales_warehouse, R.q07_rfm, recent_is_high=True),
        "quantiles_by_part": lambda s, sf: exact_quantiles(_sales_cleaned(s, sf).select("StockCode", F.col("Quantity").cast("double").alias("v")),
                                                           ["StockCode"], "v", [0.25, 0.5, 0.75]),
        "rfm_segment_counts": _with(sales_warehouse, R.rfm_segment_counts),
        "ntile_scalable": _ntile,
        "q08_monthly_product": _with(sales_warehouse, R.q08_monthly_product),
        "inventory_risk": _with(sales_warehouse, WH.inventory_risk, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST),
        "q09_risk_trend": _with(sales_warehouse, R.q09_risk_trend, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST),
        "q10_kpis": _with(sales_warehouse, R.q10_kpis),
        # the same reports over the stored schema
        "stored_q02": _with(_stored, R.q02_actual_vs_forecast),
        "stored_q07": _with(_stored, R.q07_rfm),
        "stored_q09": _with(_stored, R.q09_risk_trend, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST),
        "stored_inventory_risk": lambda s, sf: _stored(s, sf).inventory_risk,
        # the warehouse grown by two loads, and reports from its roll-ups
        "incremental_load": _incremental_load,
        "incremental_products": lambda s, sf: _kept(s, sf).dim_product,
        "incremental_customers": lambda s, sf: _kept(s, sf).dim_customer,
        "customer_history": _histories,
        "distinct_by_bitmap": _with(_kept, K.distinct_counts),
        "kept_q01": _with(_kept, K.q01_monthly_revenue),
        "kept_q08": _with(_kept, K.q08_monthly_product),
        "kept_q09": _with(_kept, K.q09_risk_trend, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST),
        "kept_q10": _with(_kept, K.q10_kpis),
        "kept_inventory_risk": _with(_kept, K.inventory_risk, high=RISK_HIGH_TEST, medium=RISK_MEDIUM_TEST),
        # warehouse tables and load checks
        "dim_date": lambda s, sf: events_warehouse(s, sf).dim_date,
        "dim_product": lambda s, sf: sales_warehouse(s, sf).dim_product,
        "dim_customer": lambda s, sf: sales_warehouse(s, sf).dim_customer,
        "dim_country": lambda s, sf: sales_warehouse(s, sf).dim_country,
        "fact_sales": _fact,
        "load_validation": _load_validation,
        "sanity_monthly": _with(sales_warehouse, WH.sanity_monthly),
        "dq_constraints": _with(_warehouse_once, WH.dq_constraints),
        "fk_orphans": _fk_orphans,
        "fact_by_lookup": _fact_by_lookup,
        "insert_ignore": _insert_ignore,
        "upsert_dim": _upsert,
        "distinct_on": _distinct_on,
        # cleaning
        "normalize_text": lambda s, sf: _dbl(_normalized(s, sf)),
        "drop_duplicates": lambda s, sf: _dbl(C.drop_duplicate_rows(_normalized(s, sf))),
        "split_cancellations": _split,
        "filter_invalid": lambda s, sf: _dbl(C.filter_invalid(_normalized(s, sf))),
        "remove_noise": lambda s, sf: _dbl(C.remove_noise(_normalized(s, sf))),
        "fill_description_mode": _fill,
        "clean_sales": lambda s, sf: _dbl(_clean_dirty(s, sf)),
        "add_features": lambda s, sf: _dbl(_sales_cleaned(s, sf)),
        "null_audit": lambda s, sf: C.null_audit(_normalized(s, sf)),
        "baseline_audit": lambda s, sf: C.baseline_audit(TD.dirty_sales(s, sf)),
        "coerce_numeric": _coerce,
        "load_merge": _load_merge,
        "load_audit": lambda s, sf: _audit(s, sf).report(),
        "load_rejects": _load_rejects,
        "load_accepted": _load_accepted,
        "csv_by_name": _csv_by_name,
        "append_parts": _append_parts,
        "forecast_file": _forecast_file,
        "default_columns": _default_columns,
        "catalog_constraints": _catalog_constraints,
        # tables of the cleaning step and EDA
        "monthly_sales": lambda s, sf: R.monthly_sales(_sales_cleaned(s, sf)),
        "monthly_by_product": lambda s, sf: R.monthly_by_product(_sales_cleaned(s, sf)),
        "revenue_by_dow": lambda s, sf: R.revenue_by_dow(_events_cleaned(s, sf)),
        "revenue_by_hour": lambda s, sf: R.revenue_by_hour(_events_cleaned(s, sf)),
        "top_products": lambda s, sf: R.top_products(_sales_cleaned(s, sf)),
        "top_countries": lambda s, sf: R.top_countries(_sales_cleaned(s, sf), exclude="NATION_0"),
        "eda_summary": lambda s, sf: R.eda_summary(_sales_cleaned(s, sf)),
        "dataset_summary": lambda s, sf: R.dataset_summary(_sales_cleaned(s, sf)),
        "boxplot_by_month": lambda s, sf: R.boxplot_by_month(_sales_cleaned(s, sf)),
    }
    q.update(FC.entry_queries())
    if (llm := _llm()) is not None:
        q.update(llm.queries())
    return q


def oracle_sql() -> dict[str, str]:
    from sqloracle.reports import SQL
    from sqloracle.store import SQL as STORE
    from sqloracle.timeseries import SQL as TS
    out = SQL | TS | STORE
    out |= {f"kept_{k}": SQL[q] for k, q in (("q01", "q01_monthly_revenue"), ("q08", "q08_monthly_product"), ("q09", "q09_risk_trend"),
                                             ("q10", "q10_kpis"), ("inventory_risk", "inventory_risk"))}
    out |= {f"stored_{k}": SQL[q] for k, q in (("q02", "q02_actual_vs_forecast"), ("q07", "q07_rfm"), ("q09", "q09_risk_trend"),
                                               ("inventory_risk", "inventory_risk"))}
    if (llm := _llm()) is not None:
        out.update(llm.oracle_sql())
    return {k: v for k, v in out.items() if k in queries()}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly revenue summary (Q1) over the star schema built from sf0.001."""
    return R.q01_monthly_revenue(sales_warehouse(spark, FLAGSHIP_SF))
