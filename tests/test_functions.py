import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillspark.functions import dates as D
from tillspark.functions.money import line_revenue, safe_ratio
from tillspark.functions.text import is_missing_text, strip_all, title_case


def test_title_case_matches_python(spark):
    texts = ["  don't t-light 12x ", "DON'T T-LIGHT 12X", "a  b", "x\ty", "3 ROSES-red", "", "école",
             "WHITE HANGING HEART T-LIGHT HOLDER", "pack of 72 retro-spot cake cases"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.t for r in df.select(title_case("s").alias("t")).collect()]
    assert got == [t.title() for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ '-1\t", max_size=12), min_size=1, max_size=8))
def test_title_case_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.t for r in df.select(title_case("s").alias("t")).collect()]
    assert got == [t.title() for t in texts]


def test_strip_all_removes_tabs_and_newlines(spark):
    df = spark.createDataFrame([("\t 85123a \n",), (" x y ",)], "s string")
    assert [r.t for r in df.select(strip_all("s").alias("t")).collect()] == ["85123a", "x y"]


def test_missing_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("Nan",), ("Name",)], "s string")
    assert [r.m for r in df.select(is_missing_text("s").alias("m")).collect()] == [True, True, True, False]


def test_date_parts(spark):
    rows = [(dt.datetime(2026, 12, 6, 13, 5),),   # Sunday
            (dt.datetime(2026, 12, 7, 0, 0),),    # Monday
            (dt.datetime(2026, 12, 31, 23, 59),),
            (dt.datetime(2027, 1, 1, 8, 0),),     # ISO week 53 of 2026
            (dt.datetime(2024, 2, 29, 10, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = df.select(D.day_of_week("ts").alias("dow"), D.day_name("ts").alias("dn"), D.iso_week("ts").alias("wk"),
                    D.date_key("ts").alias("dk"), D.year_month("ts").alias("ym"), D.month_name("ts").alias("mn")).collect()
    assert [r.dow for r in out] == [6, 0, 3, 4, 3]
    assert [r.dn for r in out] == ["Sunday", "Monday", "Thursday", "Friday", "Thursday"]
    assert out[3].wk == 53 and out[2].wk == 53
    assert out[0].dk == 2026120613 and out[4].ym == "2024-02" and out[4].mn == "February"


def test_line_revenue_exact_half_up(spark):
    rows = [(1, Decimal("1.0050")), (1, Decimal("1.0150")), (3, Decimal("0.3350")), (2, Decimal("2.5000"))]
    df = spark.createDataFrame(rows, "q int, p decimal(10,4)")
    got = [r.r for r in df.select(line_revenue("q", "p").alias("r")).collect()]
    assert got == [Decimal("1.01"), Decimal("1.02"), Decimal("1.01"), Decimal("5.00")]
    assert str(df.select(line_revenue("q", "p").alias("r")).schema["r"].dataType) == "DecimalType(12,2)"


def test_safe_ratio_no_error_on_zero(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, None), (3.0, 2)], "a double, b int")
    got = [r.x for r in df.select(safe_ratio(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [None, None, 1.5]
