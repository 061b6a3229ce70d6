"""Lookup of dimension columns that a hot key cannot slow down.

A star lookup joins every fact line with a dimension. When one key (the home country, the guest
customer) holds most lines, a shuffle by that key sends them to one task. Here

* lines without a key take the default and never join (guests);
* keys that hold at least ``share`` of the lines are found by a count per key (partial
  aggregation, so only key-sized rows move). There are at most ``1 / share`` of them, so their
  rows of the dimension are broadcast and looked up on the map side;
* the other lines join as usual; none of their keys is heavy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.functions import dates as D
from tillspark.session import written

HEAVY_SHARE = 0.001


def heavy_keys(lines: DataFrame, key: str, share: float = HEAVY_SHARE) -> DataFrame:
    """Keys of at least ``share`` of the lines that have one: at most ``1 / share`` rows."""
    counts = lines.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") >= F.greatest(total * share, F.lit(1))).select(key)


def star_lookup(lines: DataFrame, dim: DataFrame, key: str, columns: Sequence[str],
                default: dict[str, Column] | None = None, share: float = HEAVY_SHARE) -> DataFrame:
    """``lines`` with ``columns`` of the row of ``dim`` (unique in ``key``) that has their key.

    With ``default`` (a value per column) lines without a match keep it; otherwise they are
    dropped, as by an inner join. ``lines`` is read three times (the heavy keys, the lines that
    need no shuffle, the others): write it first where it is expensive.
    """
    dim = dim.select(key, *columns)
    heavy = heavy_keys(lines, key, share).join(dim.withColumn("_found", F.lit(True)), key, "left").withColumn("_heavy", F.lit(True))
    marked = lines.join(F.broadcast(heavy), key, "left")
    here = marked.filter(F.col("_heavy") | F.col(key).isNull())
    rest = marked.filter(F.col("_heavy").isNull() & F.col(key).isNotNull()).drop("_heavy", "_found", *columns)
    if default is None:
        return here.filter("_found").drop("_heavy", "_found").unionByName(rest.join(dim, key))
    both = here.drop("_heavy", "_found").unionByName(rest.join(dim, key, "left"))
    return both.withColumns({c: F.coalesce(F.col(c), value.cast(dim.schema[c].dataType)) for c, value in default.items()})


def fact_by_lookup(sales: DataFrame, products: DataFrame, countries: DataFrame, customers: DataFrame) -> DataFrame:
    """``warehouse.fact_sales`` with skew-proof lookups of all three keys; guests get the guest key."""
    lines = written(sales.select(
        F.col("Invoice").alias("invoice_no"), D.date_key("InvoiceDate").alias("date_key"), F.col("StockCode").alias("stock_code"),
        F.col("CustomerID").cast("bigint").alias("customer_id"), F.col("Country").alias("country_name"), F.col("Quantity").alias("quantity"),
        F.col("Price").cast("decimal(10,4)").alias("unit_price"), F.col("TotalRevenue").cast("decimal(12,2)").alias("total_revenue")), "lines")
    lines = written(star_lookup(lines, products, "stock_code", ["product_key"]).drop("stock_code"), "lines")
    lines = written(star_lookup(lines, countries, "country_name", ["country_key"]).drop("country_name"), "lines")
    known = customers.filter(F.col("customer_key") != schemas.GUEST_KEY)
    lines = star_lookup(lines, known, "customer_id", ["customer_key"], {"customer_key": F.lit(schemas.GUEST_KEY)})
    return lines.select("invoice_no", "date_key", "product_key", "customer_key", "country_key", "quantity", "unit_price", "total_revenue")
