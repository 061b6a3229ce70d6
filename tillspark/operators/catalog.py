"""The warehouse as catalog tables with types, defaults and constraints.

``create_tables`` makes the eight tables of the schema in a database of the session's catalog.
``insert_rows`` names the columns it has; the others take their DEFAULT (a stamp is the time of
the insert), so a loader never fills them in. What the file format does not enforce is checked in
the insert itself: a row that is NULL in a NOT NULL column, or outside a CHECK, ends the insert
and leaves the table as it was. Keys and references over whole tables are counted by
``violations``, since a distributed insert cannot see them row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.schemas import RISK_LEVELS


@dataclass(frozen=True)
class Col:
    name: str
    type: str
    null: bool = False
    default: str | None = None

    def ddl(self) -> str:
        return f"{self.name} {self.type}" + ("" if self.null else " NOT NULL") + (f" DEFAULT {self.default}" if self.default else "")


NOW = "current_timestamp()"
_LEVELS = ", ".join(f"'{x}'" for x in RISK_LEVELS)

# The columns of the stored schema, their types and defaults.
TABLES: dict[str, list[Col]] = {
    "dim_date": [Col("date_key", "INT"), Col("full_date", "DATE"), Col("year", "SMALLINT"), Col("quarter", "SMALLINT"), Col("month", "SMALLINT"),
                 Col("month_name", "STRING"), Col("week_of_year", "SMALLINT"), Col("day_of_month", "SMALLINT"), Col("day_of_week", "SMALLINT"),
                 Col("day_name", "STRING"), Col("hour", "SMALLINT"), Col("year_month", "STRING"), Col("is_weekend", "BOOLEAN", default="false")],
    "dim_product": [Col("product_key", "BIGINT"), Col("stock_code", "STRING"), Col("description", "STRING", default="'Unknown'"),
                    Col("created_at", "TIMESTAMP", default=NOW)],
    "dim_customer": [Col("customer_key", "BIGINT"), Col("customer_id", "BIGINT"), Col("has_account", "BOOLEAN", default="true"),
                     Col("created_at", "TIMESTAMP", default=NOW)],
    "dim_country": [Col("country_key", "BIGINT"), Col("country_name", "STRING"), Col("region", "STRING", default="'Other'")],
    "fact_sales": [Col("sale_id", "BIGINT"), Col("invoice_no", "STRING"), Col("date_key", "INT"), Col("product_key", "BIGINT"),
                   Col("customer_key", "BIGINT"), Col("country_key", "BIGINT"), Col("quantity", "INT"), Col("unit_price", "DECIMAL(10,4)"),
                   Col("total_revenue", "DECIMAL(12,2)"), Col("loaded_at", "TIMESTAMP", default=NOW)],
    "forecast_results": [Col("year_month", "STRING"), Col("forecast_revenue", "DECIMAL(14,2)"), Col("lower_80ci", "DECIMAL(14,2)", True),
                         Col("upper_80ci", "DECIMAL(14,2)", True), Col("model_used", "STRING", True), Col("generated_at", "TIMESTAMP", default=NOW)],
    "inventory_risk": [Col("stock_code", "STRING"), Col("description", "STRING", True), Col("avg_monthly_qty", "INT", True),
                       Col("forecast_qty", "INT", True), Col("stockout_flag", "BOOLEAN", default="false"), Col("risk_level", "STRING", True),
                       Col("updated_at", "TIMESTAMP", default=NOW)],
    "staging_sales": [Col("invoice", "STRING"), Col("stock_code", "STRING"), Col("description", "STRING", True), Col("quantity", "INT", True),
                      Col("invoice_date", "TIMESTAMP_NTZ", True), Col("price", "DECIMAL(10,4)", True), Col("customer_id", "BIGINT", True),
                      Col("country", "STRING", True)],
}
CHECKS = {"inventory_risk": {"risk_level": f"risk_level IN ({_LEVELS})"},  # a rule for the values of one column
          "fact_sales": {"quantity": "quantity > 0", "unit_price": "unit_price > 0"}}
UNIQUE = {"dim_date": ["date_key"], "dim_product": ["product_key", "stock_code"], "dim_customer": ["customer_key", "customer_id"],
          "dim_country": ["country_key", "country_name"], "fact_sales": ["sale_id"], "forecast_results": ["year_month"], "inventory_risk": ["stock_code"]}
REFERENCES = {"date_key": "dim_date", "product_key": "dim_product", "customer_key": "dim_customer", "country_key": "dim_country"}


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The database and its eight tables (existing ones stay)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for table, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({', '.join(c.ddl() for c in columns)}) USING parquet")


def insert_rows(database: str, table: str, rows: DataFrame) -> None:
    """Inserts the columns that ``rows`` has (by name); the others take their default or NULL.

    A value that does not fit its type, a NULL in a NOT NULL column, a missing column that has no
    default, or a row outside a CHECK is an error.
    """
    spark, known = rows.sparkSession, {c.name: c for c in TABLES[table]}
    if extra := [c for c in rows.columns if c not in known]:
        raise ValueError(f"{table} has no columns {extra}")
    if missing := [c.name for c in known.values() if not (c.null or c.default or c.name in rows.columns)]:
        raise ValueError(f"{table}: no value for {missing}")
    rules = {f"{c} IS NOT NULL": F.col(c).isNotNull() for c in rows.columns if not known[c].null}
    rules |= {rule: F.coalesce(F.expr(rule), F.lit(True)) for c, rule in CHECKS.get(table, {}).items() if c in rows.columns}
    checked = rows
    for name, holds in rules.items():
        checked = checked.filter(F.when(holds, F.lit(True)).otherwise(F.raise_error(F.lit(f"{table}: violates {name}"))))
    view = f"insert_{table}"
    checked.createOrReplaceTempView(view)
    try:
        names = ", ".join(rows.columns)
        spark.sql(f"INSERT INTO {database}.{table} ({names}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Name, columns and columns with a default of each table of the database."""
    found = spark.sql(f"SHOW TABLES IN {database}").filter("NOT isTemporary").select(F.col("tableName").alias("table_name")).collect()
    rows = []
    for r in found:  # one row a table of the schema
        fields = spark.table(f"{database}.{r.table_name}").schema.fields
        rows.append((r.table_name, len(fields), sum("CURRENT_DEFAULT" in f.metadata for f in fields)))
    return spark.createDataFrame(sorted(rows), "table_name string, column_count int, default_count int")


def violations(spark: SparkSession, database: str) -> DataFrame:
    """Rows against UNIQUE, NOT NULL, CHECK and references of all tables: one row per constraint."""
    out = []
    for table, columns in TABLES.items():
        df = spark.table(f"{database}.{table}")
        counts = {f"not_null({c.name})": F.count_if(F.col(c.name).isNull()) for c in columns if not c.null}
        counts |= {f"check({rule})": F.count_if(~F.expr(rule)) for rule in CHECKS.get(table, {}).values()}
        sums = df.agg(*[n.cast("bigint").alias(f"c{i}") for i, n in enumerate(counts.values())])
        pairs = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, name in enumerate(counts)])
        out.append(sums.select(F.lit(table).alias("table_name"), F.explode(pairs).alias("s")).select("table_name", "s.*"))
        for key in UNIQUE.get(table, []):
            more = df.filter(F.col(key).isNotNull()).groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n"))
            out.append(more.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations"))
                       .select(F.lit(table).alias("table_name"), F.lit(f"unique({key})").alias("check_name"), "violations"))
    fact = spark.table(f"{database}.fact_sales")
    for key, parent in REFERENCES.items():  # counted per key, so only key-sized tables meet
        used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = used.join(spark.table(f"{database}.{parent}").select(key), key, "left_anti")
        out.append(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations"))
                   .select(F.lit("fact_sales").alias("table_name"), F.lit(f"references({key})").alias("check_name"), "violations"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def load_warehouse(w, database: str) -> None:
    """The tables of a built warehouse (``sales``, dimensions, fact with ``sale_id``, reports)."""
    sales = w.sales.select(F.col("Invoice").alias("invoice"), F.col("StockCode").alias("stock_code"), F.col("Description").alias("description"),
                           F.col("Quantity").alias("quantity"), F.col("InvoiceDate").alias("invoice_date"), F.col("Price").alias("price"),
                           F.col("CustomerID").alias("customer_id"), F.col("Country").alias("country"))
    tables = {"staging_sales": sales, "dim_date": w.dim_date, "dim_product": w.dim_product, "dim_customer": w.dim_customer,
              "dim_country": w.dim_country, "fact_sales": w.fact, "forecast_results": w.forecast_results, "inventory_risk": w.inventory_risk}
    for table, df in tables.items():
        if df is not None:
            columns = [c.name for c in TABLES[table] if c.name in df.columns]
            insert_rows(database, table, df.select(*columns))
