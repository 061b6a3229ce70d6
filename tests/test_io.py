import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.operators.cleaning import clean_sales
from tillspark.sources import files


def test_load_raw_csv_parts_and_positional_names(spark, tmp_path):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    (tmp_path / "y1.csv").write_text(header + "536365,85123A,white heart,6,2009-12-01 07:45:00,2.55,13085,United Kingdom\n")
    (tmp_path / "y2.csv").write_text(header + "C536379,D,Discount,-1,2010-12-01 09:41:00,27.5,14527,United Kingdom\n"
                                     + "536366,22633,hand warmer,6,2010-12-01 08:28:00,1.85,,France\n")
    raw = files.load_raw(spark, [str(tmp_path / "y1.csv"), str(tmp_path / "y2.csv")],
                         timestamp_format="yyyy-MM-dd HH:mm:ss")
    assert raw.columns == schemas.RAW_COLUMNS and raw.count() == 3
    cleaned = clean_sales(raw).collect()
    assert sorted(r.Invoice for r in cleaned) == ["536365", "536366"]
    assert {r.Description for r in cleaned} == {"White Heart", "Hand Warmer"}


def test_write_append_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("2010-12", 1.0), ("2011-01", 2.0)], "YearMonth string, v double")
    path = str(tmp_path / "t")
    files.write_table(df, path, partition_by=["YearMonth"])
    files.write_table(df, path, mode="append", partition_by=["YearMonth"], max_records_per_file=1)
    back = spark.read.parquet(path)
    assert back.count() == 4 and back.filter("YearMonth = '2011-01'").count() == 2
    files.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["YearMonth", "v"]


def test_load_forecast_renames_and_tolerates_absence(spark, tmp_path):
    p = tmp_path / "revenue_forecast.csv"
    p.write_text("YearMonth,ForecastRevenue,Lower_80CI,Upper_80CI,ModelUsed\n2012-01,100.5,80.25,120.75,SARIMA\n")
    fr = files.load_forecast(spark, str(p)).collect()
    assert fr[0].year_month == "2012-01" and fr[0].forecast_revenue == Decimal("100.50")
    assert fr[0].model_used == "SARIMA"
    assert files.load_forecast(spark, str(tmp_path / "missing.csv")).count() == 0


def test_coerce_and_list_tables(spark):
    df = spark.createDataFrame([("17850",), ("C1",), (" 12 ",), (None,)], "c string")
    got = [r.c for r in files.coerce_numeric(df, ["c"]).collect()]
    assert got[0] == 17850 and got[1] is None and got[3] is None
    df.createOrReplaceTempView("staging_sales")
    assert "staging_sales" in [r.table_name for r in files.list_tables(spark).collect()]


def test_warehouse_write_read_roundtrip(spark, tmp_path):
    from tillspark.operators import warehouse as WH
    from tillspark.operators.features import add_features
    from tillspark.plans import reports as R
    rows = [("1", "A0001", "Lamp", 2, dt.datetime(2010, 12, 1, 8), Decimal("1.5000"), 10, "EIRE"),
            ("2", "B0002", "Mug", 1, dt.datetime(2011, 1, 5, 9), Decimal("3.0000"), None, "Japan")]
    sales = add_features(spark.createDataFrame(rows, schemas.RAW_SALES))
    built = WH.build_warehouse(sales)
    built.inventory_risk = WH.inventory_risk(built)
    built.forecast_results = spark.createDataFrame([("2011-02", Decimal("4.00"), Decimal("3.00"), Decimal("5.00"), "m")],
                                                   schemas.FORECAST_RESULTS)
    at = WH.write_warehouse(built, str(tmp_path / "wh"))
    w = WH.read_warehouse(spark, str(tmp_path / "wh"))
    ids = [r.sale_id for r in spark.read.parquet(f"{at}/fact_sales").collect()]
    assert len(set(ids)) == 2 and w.inventory_risk.count() == 2
    assert [r.forecast_revenue for r in R.q02_actual_vs_forecast(w).collect()] == [None, None, 4.0]
    # a load may read what it replaces
    assert WH.write_warehouse(w, str(tmp_path / "wh")) != at
    assert WH.read_warehouse(spark, str(tmp_path / "wh")).fact.count() == 2
    assert {r.year_month: r.total_revenue for r in R.q01_monthly_revenue(w).collect()} == {"2010-12": 3.0, "2011-01": 3.0}


def test_load_raw_reads_float_ids_and_counts_bad_fields(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("a,b,c,d,e,f,g,h\n1,A1,Lamp,2,2010-12-01 08:00:00,1.5,17850.0,EIRE\n"
                 "2,B2,Mug,six,2010-12-01 08:00:00,1.5,,EIRE\n3,B2,Mug,1,2010-12-01 08:00:00,1.5,1.5,EIRE\n")
    rows = files.load_raw(spark, str(p), on_bad="count").orderBy("Invoice").collect()
    assert [r.CustomerID for r in rows] == [17850, None, None]
    assert [r.Quantity for r in rows] == [2, None, 1] and [r.bad_fields for r in rows] == [0, 1, 1]
    with pytest.raises(ValueError, match="2 fields"):
        files.load_raw(spark, str(p))


def test_read_csv_matches_by_name(spark, tmp_path):
    p = tmp_path / "fc.csv"
    p.write_text("ModelUsed,Upper_80CI,YearMonth,ForecastRevenue,Lower_80CI,more\nm,3.0,2011-02,2.0,1.0,x\n")
    (r,) = files.load_forecast(spark, str(p)).collect()
    assert (r.year_month, float(r.forecast_revenue), float(r.lower_80ci), float(r.upper_80ci)) == ("2011-02", 2.0, 1.0, 3.0)
    p.write_text("YearMonth\n2011-02\n")
    with pytest.raises(ValueError, match="missing"):
        files.load_forecast(spark, str(p))


def test_stored_reports_come_from_stored_tables(spark, tmp_path):
    """The source of the lines is read once a load, for the staged lines."""
    from tillspark.operators import warehouse as WH
    from tillspark.operators.features import add_features
    rows = [("1", "A0001", "Lamp", 2, dt.datetime(2010, 12, 1, 8), Decimal("1.5000"), 10, "EIRE")]
    spark.createDataFrame(rows, schemas.RAW_SALES).write.parquet(str(tmp_path / "source"))
    built = WH.build_warehouse(add_features(spark.read.parquet(str(tmp_path / "source"))))
    seen = []

    def risk(stored):
        seen.extend(f for t in (stored.fact, stored.dim_product, stored.dim_date) for f in t.inputFiles())
        return WH.inventory_risk(stored)
    at = WH.write_warehouse(built, str(tmp_path / "wh"), reports={"inventory_risk": risk})
    assert seen and all(at in f for f in seen)
    assert WH.read_warehouse(spark, str(tmp_path / "wh")).inventory_risk.count() == 1
    plan = WH.with_sale_id(built.fact.withColumn("month_key", (F.col("date_key") / 10000).cast("int")))._jdf.queryExecution().executedPlan().toString()
    assert "Sort [month_key" in plan      # the order that the writer of months asks for
