"""File sources and sinks (CSV / Parquet) with explicit schemas."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark import schemas


BAD_FIELDS = "bad_fields"


def to_type(col: Column, kind: T.DataType, timestamp_format: str | None = None,
            date_format: str | None = None) -> Column:
    """Text to ``kind``; NULL where it does not parse.

    Whole numbers may be written as decimals (``17850.0``, as a column with gaps is
    written by other tools); ``17850.5`` is not one.
    """
    text = F.trim(col)
    if isinstance(kind, T.StringType):
        return col
    if isinstance(kind, T.IntegralType):
        number = text.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and timestamp_format:
        return F.try_to_timestamp(text, F.lit(timestamp_format)).cast(kind)
    if isinstance(kind, T.DateType) and date_format:
        return F.try_to_timestamp(text, F.lit(date_format)).cast("date")
    return text.try_cast(kind)


def typed(df: DataFrame, schema: T.StructType, count_bad: bool = False, **formats) -> DataFrame:
    """Text columns as the schema's types; with ``count_bad`` the number of fields of the row
    that hold text which does not parse."""
    values = {f.name: to_type(F.col(f.name), f.dataType, **formats) for f in schema.fields}
    bad = [(F.col(n).isNotNull() & (F.trim(F.col(n)) != "") & v.isNull()).cast("int") for n, v in values.items()]
    columns = [v.alias(n) for n, v in values.items()]
    return df.select(*columns, *([sum(bad[1:], bad[0]).alias(BAD_FIELDS)] if count_bad else []))


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_text(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, fmt: str = "csv", header: bool = True) -> DataFrame:
    """All parts in one scan as text columns named by ``schema``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "csv":
        return spark.read.schema(_text_schema(schema.fieldNames())).option("header", header).option("mode", "FAILFAST").csv(paths)
    if fmt != "parquet":
        raise ValueError(f"unsupported raw format: {fmt}")
    parts = [spark.read.parquet(p) for p in paths]
    text = parts[0]
    for other in parts[1:]:
        text = text.unionByName(other, allowMissingColumns=True)
    if len(text.columns) == len(schema.fields) and text.columns != schema.fieldNames():
        text = text.toDF(*schema.fieldNames())
    return text.select([F.col(n).cast("string") for n in schema.fieldNames()])


def load_raw(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv",
             schema: T.StructType = schemas.RAW_SALES, header: bool = True,
             timestamp_format: str | None = None, on_bad: str = "fail") -> DataFrame:
    """Read the yearly raw parts as one DataFrame (A1).

    All paths go into a single scan, so the parts are read in parallel and the union
    costs nothing. CSV parts are positional: their columns are named by the schema,
    whatever the header says (B1). Parquet parts are matched by name
    (``unionByName``), so parts with a different column order still line up.

    Fields that hold text which is not of their type: ``on_bad="fail"`` stops the load and
    tells how many (it reads the input once for that), ``"raise"`` lets the first such row end
    the job that reads the rows (one pass in all), ``"count"`` keeps the rows, with NULL there
    and their number in a column ``bad_fields``. ``audit.audited_load`` puts them aside.
    """
    if on_bad not in ("fail", "count", "raise"):
        raise ValueError(f"on_bad: {on_bad}")
    text = read_text(spark, paths, schema, fmt, header)
    rows = typed(text, schema, count_bad=True, timestamp_format=timestamp_format)
    if on_bad == "count":
        return rows
    if on_bad == "raise":
        fine = F.when(F.col(BAD_FIELDS) == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.col(BAD_FIELDS), F.lit(" fields of a row do not parse"))))
        return rows.filter(fine).drop(BAD_FIELDS)
    bad = rows.agg(F.sum(BAD_FIELDS)).first()[0] or 0
    if bad:
        raise ValueError(f"{bad} fields do not parse; load with on_bad='count' to see them")
    return rows.drop(BAD_FIELDS)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             timestamp_format: str | None = None, date_format: str | None = None) -> DataFrame:
    """CSV scan matched by header name, whatever the order of the columns (A2, A5).

    Text that does not parse becomes NULL; further columns of the file are left out, and a
    missing one is an error.
    """
    text = spark.read.option("header", True).csv(path)
    missing = [n for n in schema.fieldNames() if n not in text.columns]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    return typed(text, schema, timestamp_format=timestamp_format, date_format=date_format)


def coerce_numeric(df: DataFrame, columns: Iterable[str], to: str = "bigint") -> DataFrame:
    """Text to nullable number; unparsable values become NULL, ``17850.0`` is whole (A3)."""
    kind = T._parse_datatype_string(to)
    return df.withColumns({c: to_type(F.col(c).cast("string"), kind) for c in columns})


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None,
                max_records_per_file: int | None = None) -> None:
    """Write a table.

    ``mode='append'`` is the chunked append of the loader; every task writes its own
    files, and ``max_records_per_file`` bounds file size instead of a driver loop over
    chunks. CSV output carries a header.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported sink format: {fmt}")


def load_forecast(spark: SparkSession, path: str | None) -> DataFrame:
    """Forecast file -> ``forecast_results`` columns.

    A missing file is not an error: the result is an empty table of the schema, so the
    actual-against-forecast report still runs.
    """
    empty = spark.createDataFrame([], schemas.FORECAST_RESULTS)
    if not path:
        return empty
    try:
        raw = read_csv(spark, path, schemas.REVENUE_FORECAST_CSV)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    renamed = raw.withColumnsRenamed(schemas.FORECAST_COLUMN_NAMES)
    return renamed.select([F.col(f.name).cast(f.dataType) for f in schemas.FORECAST_RESULTS.fields])


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current catalog."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("table_name"),
                                           F.col("isTemporary").alias("is_temporary"))
