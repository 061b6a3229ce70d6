"""A warehouse that grows load by load.

Month-partitioned tables (rewritten for the months that got new lines, never for others):

* ``staging_sales``  cleaned lines with their ``sale_id``; the base of everything below
* ``fact_sales``     lines with surrogate keys, sorted by customer in each file, with Bloom filters
  of products and invoices, for lookups of a few lines (``lines_of``)
* ``product_names``  lines per (stock code, description)
* ``daily_product``, ``monthly_product``  revenue, units, lines per product and day or month
* ``distinct_bits``  daily bitmaps of invoices, customers and products

Key tables: ``dim_date``, ``dim_customer``, ``dim_country``, ``dim_invoice`` get rows appended for
new keys; ``dim_product`` is rewritten per load, as descriptions change (A12).

A load takes a batch of cleaned lines:

1. Lines already stored are left out. Equal lines count: of a line that is stored m times and
   comes n times, n - m are new. Only the months of the batch are read for this.
2. New lines are numbered on from the highest ``sale_id`` in date order, and staged.
3. New stock codes, countries and invoices are numbered on from the highest key; existing keys
   stay. A product's description is its most frequent one over all loads (lowest on ties).
4. The other month tables are rebuilt from the staged lines of the changed months alone.

Two loads that share lines thus equal one load of both. Months are overwritten dynamically, from
files that stay until the job commits. Before staging, the months to change are recorded; a load
that failed half-way is completed by the next one, as steps 3 and 4 depend on staged lines only.
The state is a table per load, and the latest complete one counts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark import schemas
from tillspark.functions import dates as D
from tillspark.operators import warehouse as WH
from tillspark.operators.bitmaps import distinct_bits
from tillspark.operators.lookup import star_lookup
from tillspark.operators.ranking import global_row_number
from tillspark.session import written

LINE = ["InvoiceDate", "Invoice", "StockCode", "CustomerID", "Country", "Quantity", "Price", "TotalRevenue", "Description"]
STATE = "version int, products string, next_sale_id bigint, pending array<int>"
PART_LINES = 500_000  # lines of a month that one task rolls up
KINDS = ["invoice", "product", "customer", "guest"]


@dataclass
class KeptWarehouse(WH.Warehouse):
    """A warehouse with its kept roll-ups."""

    daily_product: DataFrame | None = None
    monthly_product: DataFrame | None = None
    distinct_bits: DataFrame | None = None
    dim_invoice: DataFrame | None = None

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        """Exact revenue per month, from the monthly roll-up: no fact line is read."""
        months, kept = self.monthly_product.filter("month_key IS NOT NULL"), self.monthly_product.schema["revenue"].dataType
        name = F.format_string("%04d-%02d", F.floor(F.col("month_key") / 100), F.col("month_key") % 100)
        return written(months.groupBy(name.alias("year_month")).agg(F.sum("revenue").cast(kept).alias("revenue")), "monthly")


def month_of(date: str) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("int")


class Store:
    """The tables under ``path``; ``load`` adds a batch, ``read`` gives the warehouse."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def children(self, folder: str) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def exists(self, name: str) -> bool:
        """Whether a write of the table has been completed (whole months leave no mark of their own)."""
        return any(c == "_SUCCESS" or c.startswith("month_key=") for c in self.children(name))

    def table(self, name: str, schema: T.StructType | str | None = None) -> DataFrame:
        if schema is not None and not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.path}/{name}")

    def months(self, name: str, months: list[int]) -> DataFrame:
        """The rows of some months: the filter is on the partition column, others are not listed."""
        return self.table(name).filter(F.col("month_key").isin(months))

    def state(self):
        done = sorted(v for v in self.children("_state") if self.exists(f"_state/{v}"))
        return self.table(f"_state/{done[-1]}").first() if done else None

    def set_state(self, version: int, products: str | None, next_sale_id: int, pending: list[int]) -> None:
        row = self.spark.createDataFrame([(version, products, next_sale_id, pending)], STATE).coalesce(1)
        row.write.parquet(f"{self.path}/_state/{version:08d}")

    def overwrite_months(self, name: str, df: DataFrame, order: list[str], bloom: tuple[str, ...] = (), deal: bool = True) -> None:
        """Writes whole months; months that are not in ``df`` keep their files.

        Rows are dealt by month (unless ``deal`` is off: for rows that come by month), where AQE
        splits a month that is too large for one task and puts small ones together. ``bloom``
        columns get a Bloom filter per row group.
        """
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}
        dealt = df.hint("rebalance", "month_key") if deal else df
        (dealt.sortWithinPartitions("month_key", *order).write.options(**filters)
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_key").parquet(f"{self.path}/{name}"))

    def append_new(self, name: str, rows: DataFrame, key: str, number: str | None = None, order: list[str] | None = None) -> None:
        """Appends rows whose key is not stored (A11), numbered on from the highest number."""
        schema = T.StructType([*([T.StructField(number, T.LongType())] if number else []), *rows.schema.fields])
        known = self.table(name, schema)
        fresh = rows.join(known.select(key), key, "left_anti")
        if number:
            highest = known.agg(F.coalesce(F.max(number), F.lit(0))).first()[0]
            fresh = global_row_number(fresh, order or [key], out=number).withColumn(number, F.col(number).cast("bigint") + highest)
        fresh.select(*schema.fieldNames()).write.mode("append").parquet(f"{self.path}/{name}")

    # -- a load ---------------------------------------------------------------------------

    def staged_months(self) -> set[int]:
        """Months with staged lines, from the names of their folders."""
        return {int(c.split("=")[1]) for c in self.children("staging_sales") if c.startswith("month_key=") and c.split("=")[1].isdigit()}

    def fresh_lines(self, batch: DataFrame, months: list[int]) -> DataFrame:
        """Lines of the batch that are not stored, as often as they come more than they are.

        Lines of months without staged lines are all new and are not compared.
        """
        both = sorted(self.staged_months().intersection(months))
        if not both:
            return batch
        stored = F.coalesce(F.col("month_key").isin(both), F.lit(False))
        marked = (batch.filter(stored).select(*LINE, "month_key", F.lit(1).alias("_n"))
                  .unionByName(self.months("staging_sales", both).select(*LINE, "month_key", F.lit(-1).alias("_n"))))
        more = marked.groupBy(*LINE, "month_key").agg(F.sum("_n").cast("int").alias("_more")).filter("_more > 0")
        more = more.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_more")))).drop("_more", "_copy")
        return batch.filter(~stored).unionByName(written(more, "fresh"))

    def load(self, sales: DataFrame, regions: DataFrame | None = None) -> list[int]:
        """Adds cleaned lines (``LINE``); returns the months that changed."""
        state = self.state()
        version, products, next_id, pending = tuple(state) if state else (0, None, 1, [])
        batch = written(sales.select(*LINE).withColumn("month_key", month_of("InvoiceDate")), "batch")
        months = [r.month_key for r in batch.select("month_key").distinct().collect()]  # calendar months
        fresh = self.fresh_lines(batch, months)
        new = {r.month_key: r.n for r in fresh.groupBy("month_key").agg(F.count(F.lit(1)).alias("n")).collect()}
        changed = sorted({*new, *pending})
        if not changed:
            return []
        self.set_state(version + 1, products, next_id + sum(new.values()), changed)
        if new:
            numbered = global_row_number(fresh, LINE, out="sale_id")
            staged = numbered.withColumn("sale_id", F.col("sale_id").cast("bigint") + (next_id - 1))
            if self.exists("staging_sales"):
                staged = staged.unionByName(self.months("staging_sales", list(new)).select(*staged.columns))
            # Numbered lines lie in ranges of their date, so a month is in few tasks: no shuffle.
            self.overwrite_months("staging_sales", staged, ["InvoiceDate", "Invoice"], deal=False)
        self.refresh(changed, regions)
        products = self.write_products(changed, products)
        self.set_state(version + 2, products, next_id + sum(new.values()), [])
        return changed

    def refresh(self, changed: list[int], regions: DataFrame | None) -> None:
        """Keys and month tables that follow from the staged lines of ``changed``."""
        staged = self.months("staging_sales", changed)
        self.append_new("dim_date", WH.dim_date(staged), "date_key")
        self.append_new("dim_customer", WH.dim_customer(staged), "customer_key")
        self.append_new("dim_country", WH.country_regions(staged, regions), "country_name", "country_key")
        self.append_new("product_keys", staged.select(F.col("StockCode").alias("stock_code")).distinct(), "stock_code", "product_key")
        invoices = staged.groupBy(F.col("Invoice").alias("invoice_no")).agg(F.min("InvoiceDate").alias("first_at"))
        self.append_new("dim_invoice", invoices, "invoice_no", "invoice_key", ["first_at", "invoice_no"])
        fact = self.fact_of(staged)
        self.overwrite_months("fact_sales", fact, ["customer_key", "date_key", "sale_id"], bloom=("product_key", "invoice_no"))
        self.overwrite_months("product_names", staged.groupBy("month_key", F.col("StockCode").alias("stock_code"), "Description")
                              .agg(F.count(F.lit(1)).alias("lines")), ["stock_code"])
        most = staged.groupBy("month_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        parts_of = 1 + (most or 0) // PART_LINES  # tasks that share the roll-ups of a month
        day = F.to_date((F.floor(F.col("date_key") / 100)).cast("string"), "yyyyMMdd")
        facts = self.months("fact_sales", changed).withColumn("full_date", day)
        sums = [F.sum("total_revenue").alias("revenue"), F.sum("quantity").cast("bigint").alias("units"), F.count(F.lit(1)).alias("lines")]
        parts = F.pmod(F.xxhash64("full_date", "product_key"), F.lit(parts_of))
        daily = (facts.withColumn("_part", parts).repartition("month_key", "_part")  # one exchange, for the sums and for the files
                 .groupBy("month_key", "_part", "full_date", "product_key").agg(*sums).drop("_part"))
        self.overwrite_months("daily_product", daily, ["full_date", "product_key"], deal=False)
        daily = self.months("daily_product", changed)
        self.overwrite_months("monthly_product", daily.groupBy("month_key", "product_key").agg(
            *[F.sum(c).cast(daily.schema[c].dataType).alias(c) for c in ("revenue", "units", "lines")]), ["product_key"])
        known = F.col("customer_key") != schemas.GUEST_KEY
        kinds = {"invoice": F.col("invoice_key"), "product": F.col("product_key"), "customer": F.when(known, F.col("customer_key")),
                 "guest": F.when(~known, F.lit(1))}
        bits = distinct_bits(facts, ["month_key", "full_date"], kinds, deal=["month_key"], parts=parts_of)
        self.overwrite_months("distinct_bits", bits, [], deal=False)  # 4 KB a row: not sorted again

    def fact_of(self, staged: DataFrame) -> DataFrame:
        lines = staged.select(
            "sale_id", F.col("Invoice").alias("invoice_no"), D.date_key("InvoiceDate").alias("date_key"),
            F.col("StockCode").alias("stock_code"), F.col("CustomerID").cast("bigint").alias("customer_id"),
            F.col("Country").alias("country_name"), F.col("Quantity").alias("quantity"), F.col("Price").cast("decimal(10,4)").alias("unit_price"),
            F.col("TotalRevenue").cast("decimal(12,2)").alias("total_revenue"), "month_key")
        customers = self.table("dim_customer").filter(F.col("customer_key") != schemas.GUEST_KEY)
        # Stored key tables have known sizes: small ones are broadcast without an exchange of the lines.
        # The customers' lookup reads its lines three times: it comes before the large invoice lookup.
        lines = (lines.join(self.table("dim_country").select("country_name", "country_key"), "country_name").drop("country_name")
                 .join(self.table("product_keys"), "stock_code").drop("stock_code"))
        lines = star_lookup(lines, customers, "customer_id", ["customer_key"], {"customer_key": F.lit(schemas.GUEST_KEY)})
        return lines.drop("customer_id").join(self.table("dim_invoice").select("invoice_no", "invoice_key"), "invoice_no")

    def write_products(self, changed: list[int], before: str | None) -> str:
        """The product dimension: codes with lines in ``changed`` get their description anew."""
        touched = self.months("product_names", changed).select("stock_code").distinct()
        names = (self.table("product_names").join(touched, "stock_code", "left_semi")
                 .groupBy("stock_code", "Description").agg(F.sum("lines").alias("_n")))
        rank = F.struct(F.col("Description").isNull().alias("missing"), (-F.col("_n")).alias("n"), F.col("Description"))
        modes = names.groupBy("stock_code").agg(F.coalesce(F.min_by("Description", rank), F.lit(schemas.DEFAULT_DESCRIPTION)).alias("description"))
        rows = self.table("product_keys").join(modes, "stock_code").select("product_key", "stock_code", "description")
        if before:
            rows = WH.upsert(self.table(before), rows, "stock_code")
        name = f"dim_product-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    # -- reading --------------------------------------------------------------------------

    def lines_of(self, customer_id: int | None = None, stock_code: str | None = None, invoice_no: str | None = None) -> DataFrame:
        """Fact lines of a customer, a product, an invoice, or of what is given of them.

        The fact is sorted by customer within its files, so page statistics skip other customers;
        for products and invoices Bloom filters skip row groups. The key of a product is looked up
        first, so that the filter on the fact is one on literals, which reaches the scan.
        """
        w = self.read()
        lines = w.fact
        if customer_id is not None:
            lines = lines.filter(F.col("customer_key") == customer_id)
        if invoice_no is not None:
            lines = lines.filter(F.col("invoice_no") == invoice_no)
        if stock_code is not None:
            found = w.dim_product.filter(F.col("stock_code") == stock_code).select("product_key").first()
            lines = lines.filter(F.col("product_key") == (found.product_key if found else -1))
        return lines

    def read(self) -> KeptWarehouse:
        """The warehouse as of the last complete load."""
        state = self.state()
        if state is None or state.pending:
            raise ValueError(f"{self.path}: no complete load")
        return KeptWarehouse(
            sales=self.table("staging_sales"), dim_date=self.table("dim_date"), dim_product=self.table(state.products),
            dim_customer=self.table("dim_customer"), dim_country=self.table("dim_country"), fact=self.table("fact_sales"),
            daily_product=self.table("daily_product"), monthly_product=self.table("monthly_product"),
            distinct_bits=self.table("distinct_bits"), dim_invoice=self.table("dim_invoice"))
