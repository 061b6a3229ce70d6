"""Raw load with an audit and a quarantine, in one pass over the input.

Every row is typed and held against the rules; the accepted and the rejected rows go to one
write, partitioned by ``accepted``, and the counts per rule are observed while it runs. Rejected
rows keep their values as far as they parse, the text they came as, and the names of all rules
they break, so that they can be mended and loaded again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark import schemas
from tillspark.functions.text import strip_all
from tillspark.sources.files import read_text, to_type

RULES, RAW_TEXT = "broken_rules", "raw_text"


def sales_rules() -> dict[str, Column]:
    """Rules of a raw sales line: name -> true where the row breaks it."""
    code = F.upper(strip_all(F.col("StockCode")))
    return {
        "missing(Invoice)": F.col("Invoice").isNull(),
        "missing(StockCode)": F.col("StockCode").isNull(),
        "missing(InvoiceDate)": F.col("InvoiceDate").isNull(),
        "cancelled": strip_all(F.col("Invoice")).startswith("C"),
        "check(Quantity > 0)": F.col("Quantity") <= 0,
        "check(Price > 0)": F.col("Price") <= 0,
        "noise_code": code.isin(schemas.NOISE_CODES) | (F.length(code) < schemas.MIN_CODE_LENGTH),
    }


def risk_rules() -> dict[str, Column]:
    return {"missing(stock_code)": F.col("stock_code").isNull(),
            "check(risk_level)": ~F.col("risk_level").isin(schemas.RISK_LEVELS),
            "missing(stockout_flag)": F.col("stockout_flag").isNull()}


def forecast_rules() -> dict[str, Column]:
    return {"missing(year_month)": F.col("year_month").isNull(), "missing(forecast_revenue)": F.col("forecast_revenue").isNull()}


def judged(rows: DataFrame, rules: dict[str, Column], first: Sequence[Column] = ()) -> DataFrame:
    """``rows`` with the array of the names of the rules that each row breaks (NULL breaks none)."""
    names = [F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]
    return rows.withColumn(RULES, F.array_compact(F.array(*first, *names)))


@dataclass
class LoadAudit:
    """What a load accepted, what it rejected (with all rules a row broke), and the counts."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]

    def report(self) -> DataFrame:
        """One row per rule, and the rows read, accepted and rejected."""
        spark = self.accepted.sparkSession
        return spark.createDataFrame(sorted(self.counts.items()), "rule string, row_count bigint")

    def rejects_by_rule(self) -> DataFrame:
        """One row per rejected row and rule."""
        return self.rejected.withColumn("rule", F.explode(RULES)).drop(RULES)


def audited(rows: DataFrame, rules: Sequence[str], path: str) -> LoadAudit:
    """Writes judged rows to ``path``, accepted and rejected ones apart, counting on the way."""
    fine = F.size(RULES) == 0
    seen = Observation()
    names = [f"r{i}" for i in range(len(rules))]
    watched = rows.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(fine).alias("accepted"),
                           *[F.count_if(F.array_contains(RULES, rule)).alias(n) for n, rule in zip(names, rules)])
    watched.withColumn("accepted", fine).write.partitionBy("accepted").parquet(path)
    got = seen.get
    counts = {"rows read": got["read"], "rows accepted": got["accepted"], "rows rejected": got["read"] - got["accepted"]}
    counts |= {rule: got[n] for n, rule in zip(names, rules)}
    spark = rows.sparkSession
    stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("accepted", T.BooleanType())])).parquet(path)
    return LoadAudit(stored.filter("accepted").drop("accepted", RULES, RAW_TEXT), stored.filter("NOT accepted").drop("accepted"), counts)


def audited_load(spark: SparkSession, paths: str | Sequence[str], path: str, schema: T.StructType = schemas.RAW_SALES,
                 rules: dict[str, Column] | None = None, timestamp_format: str | None = None, fmt: str = "csv") -> LoadAudit:
    """Raw parts -> typed rows under ``path``, judged; the input is read once.

    A field with text that is not of its type breaks ``unparsable(field)``.
    """
    rules = sales_rules() if rules is None else rules
    text = read_text(spark, paths, schema, fmt)
    values = {f.name: to_type(F.col(f.name), f.dataType, timestamp_format=timestamp_format) for f in schema.fields}
    unparsable = {f"unparsable({n})": F.col(n).isNotNull() & (F.trim(F.col(n)) != "") & v.isNull() for n, v in values.items()
                  if not isinstance(schema[n].dataType, T.StringType)}
    faults = F.array(*[F.when(bad, F.lit(name)) for name, bad in unparsable.items()])
    typed = text.select(*[v.alias(n) for n, v in values.items()], F.struct(*text.columns).alias(RAW_TEXT), faults.alias("_faults"))
    rows = judged(typed, rules, [F.col("_faults")[i] for i in range(len(unparsable))]).drop("_faults")
    return audited(rows, [*unparsable, *rules], path)
