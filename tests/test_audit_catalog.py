import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.operators import catalog as CT
from tillspark.operators import warehouse as WH
from tillspark.operators.features import add_features
from tillspark.session import shared_path
from tillspark.sources import audit as A
from tillspark.sources import files

HEADER = ",".join(schemas.RAW_COLUMNS)


@pytest.fixture()
def raw(tmp_path):
    lines = ["1,A0001,Lamp,2,2011-01-02 08:00:00,1.50,10,EIRE",
             "C2,A0001,Lamp,-2,2011-01-02 08:00:00,1.50,10.0,EIRE",
             "3,POST,,1,2011-01-02 08:00:00,0,,USA",
             "4,B0002,Mug,two,2011-01-02,abc,10.5,USA",
             ",,,1,,1,,",
             "5,A0001,Lamp,2,2011-01-03 08:00:00,1.50,10,EIRE"]
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *lines[:3]]))
    (tmp_path / "b.csv").write_text("\n".join([HEADER, *lines[3:]]))
    return [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]


def test_audited_load(spark, raw, tmp_path):
    got = A.audited_load(spark, raw, str(tmp_path / "out"))
    assert sorted(r.Invoice for r in got.accepted.collect()) == ["1", "5"] and got.accepted.columns == schemas.RAW_COLUMNS
    rules = {r.raw_text.Invoice: r.broken_rules for r in got.rejected.collect()}
    assert rules == {"C2": ["cancelled", "check(Quantity > 0)"], "3": ["check(Price > 0)", "noise_code"],
                     "4": ["unparsable(Quantity)", "unparsable(Price)", "unparsable(CustomerID)"],
                     None: ["missing(Invoice)", "missing(StockCode)", "missing(InvoiceDate)"]}
    kept = got.rejected.filter("Invoice = '4'").first()
    assert kept.raw_text.Quantity == "two" and kept.Quantity is None and kept.InvoiceDate == dt.datetime(2011, 1, 2)
    counts = {r.rule: r.row_count for r in got.report().collect()}
    assert counts["rows read"] == 6 and counts["rows accepted"] == 2 and counts["rows rejected"] == 4 and counts["cancelled"] == 1
    assert counts["missing(Invoice)"] == 1 and counts["unparsable(InvoiceDate)"] == 0
    assert got.rejects_by_rule().count() == 10


def test_audited_load_of_no_rows(spark, tmp_path):
    (tmp_path / "none.csv").write_text(HEADER + "\n")
    got = A.audited_load(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"))
    assert got.counts["rows read"] == 0 and got.accepted.count() == 0 and got.rejects_by_rule().count() == 0


def test_rules_of_the_report_tables(spark, tmp_path):
    risk = spark.createDataFrame([("A", "LOW", True), ("B", "low", False), (None, None, None)], "stock_code string, risk_level string, stockout_flag boolean")
    rules = A.risk_rules()
    got = A.audited(A.judged(risk, rules), list(rules), str(tmp_path / "risk"))
    assert [r.stock_code for r in got.accepted.collect()] == ["A"]
    assert got.counts["check(risk_level)"] == 1 and got.counts["missing(stock_code)"] == 1
    forecast = spark.createDataFrame([("2011-01", 1.0), ("2011-02", None)], "year_month string, forecast_revenue double")
    rules = A.forecast_rules()
    assert A.audited(A.judged(forecast, rules), list(rules), str(tmp_path / "fc")).counts["missing(forecast_revenue)"] == 1


def test_load_raw_raises_in_the_reading_job(spark, raw):
    rows = files.load_raw(spark, raw, on_bad="raise")
    with pytest.raises(Exception, match="fields of a row do not parse"):
        rows.count()
    assert files.load_raw(spark, raw[:1], on_bad="raise").count() == 3


@pytest.fixture()
def database(spark):
    name = f"t_{uuid.uuid4().hex}"
    CT.create_tables(spark, name, shared_path(spark, name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_tables_defaults_and_checks(spark, database):
    found = {r.table_name: (r.column_count, r.default_count) for r in CT.list_tables(spark, database).collect()}
    assert set(found) == set(CT.TABLES) and found["dim_product"] == (4, 2) and found["fact_sales"] == (10, 1)
    keys = spark.createDataFrame([(1, "A0001")], "product_key bigint, stock_code string")
    CT.insert_rows(database, "dim_product", keys)
    row = spark.table(f"{database}.dim_product").first()
    assert row.description == "Unknown" and row.created_at is not None
    for bad, message in ((keys.withColumn("stock_code", F.lit(None).cast("string")), "stock_code IS NOT NULL"),
                         (keys.select("product_key"), "no value"), (keys.withColumn("colour", F.lit(1)), "no columns")):
        with pytest.raises(Exception, match=message):
            CT.insert_rows(database, "dim_product", bad)
    risk = spark.createDataFrame([("A", "SEVERE")], "stock_code string, risk_level string")
    with pytest.raises(Exception, match="risk_level IN"):
        CT.insert_rows(database, "inventory_risk", risk)
    CT.insert_rows(database, "inventory_risk", risk.withColumn("risk_level", F.lit(None).cast("string")))
    assert spark.table(f"{database}.inventory_risk").first().stockout_flag is False
    assert spark.table(f"{database}.dim_product").count() == 1


def test_violations_are_counted(spark, database):
    rows = [("1", "A0001", "Lamp", 2, dt.datetime(2011, 1, 2, 8), Decimal("1.5"), 10, "EIRE"), ("2", "B0002", "Mug", 1, dt.datetime(2011, 1, 3, 9), Decimal("3"), None, "USA")]
    w = WH.build_warehouse(add_features(spark.createDataFrame(rows, schemas.RAW_SALES)))
    w.fact = WH.with_sale_id(w.fact)
    CT.load_warehouse(w, database)
    assert all(r.violations == 0 for r in CT.violations(spark, database).collect())
    CT.insert_rows(database, "dim_product", w.dim_product)                              # every key twice
    CT.insert_rows(database, "inventory_risk", spark.createDataFrame([("A",), ("A",), ("B",)], "stock_code string"))
    fact = spark.table(f"{database}.fact_sales").drop("loaded_at").withColumn("country_key", F.lit(99).cast("bigint"))
    CT.insert_rows(database, "fact_sales", fact)
    broken = {(r.table_name, r.check_name): r.violations for r in CT.violations(spark, database).collect() if r.violations}
    assert broken == {("dim_product", "unique(product_key)"): 2, ("dim_product", "unique(stock_code)"): 2, ("inventory_risk", "unique(stock_code)"): 1,
                      ("fact_sales", "unique(sale_id)"): 2, ("fact_sales", "references(country_key)"): 2}
