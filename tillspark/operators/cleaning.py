"""Cleaning steps of raw invoice lines (B1-B7, D11-D12) and the end-to-end job.

Each step is a narrow DataFrame transformation; only the de-duplication and the
description mode exchange data. Filters written after the de-duplication are row
predicates on the grouping columns, so Catalyst pushes them below it and fewer rows
are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.session import written
from tillspark.functions.text import is_missing_text, strip_all, title_case
from tillspark.operators.features import add_features


def normalize_text(df: DataFrame) -> DataFrame:
    """Positional names, stripped text, upper-case codes, title-case descriptions (B1, B2).

    Missing descriptions stay NULL (blank text and the literal 'nan' count as missing),
    so they can never win the description mode later.
    """
    if df.columns[:len(schemas.RAW_COLUMNS)] != schemas.RAW_COLUMNS and len(df.columns) == len(schemas.RAW_COLUMNS):
        df = df.toDF(*schemas.RAW_COLUMNS)
    # Title case is a higher-order function (interpreted): compute it once, then test it.
    titled = df.withColumns({
        "Invoice": strip_all(F.col("Invoice").cast("string")),
        "StockCode": F.upper(strip_all(F.col("StockCode").cast("string"))),
        "Description": title_case(strip_all("Description")),
        "Quantity": F.col("Quantity").cast("int"),
        "CustomerID": F.col("CustomerID").cast("bigint"),
        "Country": strip_all(F.col("Country").cast("string")),
    })
    return titled.withColumn("Description", F.when(is_missing_text("Description"), F.lit(None).cast("string"))
                             .otherwise(F.col("Description")))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates over all columns; NULLs compare equal.

    A hash aggregate with map-side partial aggregation: a group of copies collapses in
    every map task before the shuffle, so a hot group sends one row per task.
    """
    return df.dropDuplicates()


def split_cancellations(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flag invoices starting with a capital 'C'; return (sales, cancelled)."""
    flagged = df.withColumn("IsCancelled", F.coalesce(F.col("Invoice").startswith("C"), F.lit(False)))
    return flagged.filter(~F.col("IsCancelled")), flagged.filter(F.col("IsCancelled"))


def filter_invalid(df: DataFrame) -> DataFrame:
    """Keep lines with positive quantity and positive price."""
    return df.filter((F.col("Quantity") > 0) & (F.col("Price") > 0))


def remove_noise(df: DataFrame, codes: Sequence[str] = tuple(schemas.NOISE_CODES),
                 min_len: int = schemas.MIN_CODE_LENGTH) -> DataFrame:
    """Drop postage/fee codes and codes shorter than ``min_len``."""
    return df.filter(~F.col("StockCode").isin(list(codes)) & (F.length("StockCode") >= min_len))


def group_mode(df: DataFrame, key: str, col: str) -> DataFrame:
    """Most frequent non-missing ``col`` per ``key``, the smallest on ties.

    Counts per (key, value) first, then the best of them per key: no task holds a map of
    all values of a key.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(col, F.struct((-F.col("_n")).alias("n"), F.col(col))).alias(f"_mode_{col}"))


def fill_by_group_mode(df: DataFrame, key: str = "StockCode", col: str = "Description",
                       default: str = schemas.DEFAULT_DESCRIPTION) -> DataFrame:
    """Fill missing ``col`` with the mode of its ``key`` group, else ``default``.

    Only the lines that need a fill meet the mode table; lines that already have a
    value pass through untouched, so the fact-sized side is never shuffled for the join.
    The lines are read three times (modes, complete, missing), and the branch filters
    would be pushed below an earlier de-duplication and run it three times, so they are
    written to the shared folder once.
    """
    df = written(df, "lines")
    modes = group_mode(df, key, col)
    complete = df.filter(F.col(col).isNotNull())
    missing = (df.filter(F.col(col).isNull())
               .join(modes, key, "left")
               .withColumn(col, F.coalesce(F.col(f"_mode_{col}"), F.lit(default)))
               .drop(f"_mode_{col}"))
    return complete.unionByName(missing.select(*df.columns))


def clean_sales(raw: DataFrame) -> DataFrame:
    """Raw lines -> cleaned sales with features.

    normalise -> drop duplicates -> drop cancellations -> drop invalid -> drop noise
    codes -> fill descriptions -> date parts and revenue. The reference fills before it
    drops noise codes; the result is the same (modes are per stock code and noise codes
    leave entirely), and filtering first lets the predicate reach the scan and keeps
    noise lines out of the written input of the fill.
    """
    df = normalize_text(raw)
    df = drop_duplicate_rows(df)
    df, _cancelled = split_cancellations(df)
    df = filter_invalid(df)
    df = remove_noise(df)
    df = fill_by_group_mode(df)
    return add_features(df)


def null_audit(df: DataFrame) -> DataFrame:
    """Null count and percentage per column, one row per column.

    One pass: a single global aggregate of ``count_if(isnull)`` per column, then an
    unpivot of that one row.
    """
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    long = counts.selectExpr("_rows", f"stack({len(cols)}, {stack}) as (column_name, null_count)")
    return long.select(
        "column_name",
        F.col("null_count").cast("bigint").alias("null_count"),
        F.round(F.try_divide(F.col("null_count") * 100.0, F.col("_rows")), 2).alias("null_pct"))


def baseline_audit(raw: DataFrame) -> DataFrame:
    """Counts of the faults in a raw extract (D12): one row.

    ``duplicate_rows`` = rows - distinct rows (same definition as pandas'
    ``duplicated().sum()``).
    """
    norm = normalize_text(raw)
    totals = norm.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("CustomerID").isNull()).alias("missing_customer"),
        F.count_if(F.col("Description").isNull()).alias("missing_description"),
        F.count_if(F.col("Quantity") < 0).alias("negative_quantity"),
        F.count_if(F.col("Price") <= 0).alias("nonpositive_price"),
        F.count_if(F.col("Invoice").startswith("C")).alias("cancelled_rows"),
    )
    distinct_rows = norm.distinct().agg(F.count(F.lit(1))).scalar()
    return totals.select(
        "total_rows", (F.col("total_rows") - distinct_rows).alias("duplicate_rows"),
        "missing_customer", "missing_description", "negative_quantity", "nonpositive_price",
        "cancelled_rows")
