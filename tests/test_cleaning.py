import datetime as dt
from decimal import Decimal

from tillspark import schemas
from tillspark.operators import cleaning as C

T0 = dt.datetime(2010, 12, 1, 8, 26)


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_SALES)


def line(inv="536365", code="85123A", desc="WHITE HEART", q=6, ts=T0, p="2.5500", cust=17850, ctry="United Kingdom"):
    return (inv, code, desc, q, ts, Decimal(p), cust, ctry)


def test_duplicates_after_trimming_and_null_customers(spark):
    df = raw(spark, [line(code=" 85123a"), line(code="85123A\t"), line(cust=None), line(cust=None)])
    out = C.drop_duplicate_rows(C.normalize_text(df))
    assert out.count() == 2


def test_only_capital_c_cancels(spark):
    df = C.normalize_text(raw(spark, [line(inv="C536379"), line(inv="536365"), line(inv="c1")]))
    sales, cancelled = C.split_cancellations(df)
    assert sorted(r.Invoice for r in cancelled.collect()) == ["C536379"]
    assert sorted(r.Invoice for r in sales.collect()) == ["536365", "c1"]


def test_invalid_quantity_and_price(spark):
    rows = [line(q=q, p=p) for q in (0, -1, 1) for p in ("0.0000", "-1.0000", "1.0000")]
    out = C.filter_invalid(raw(spark, rows))
    assert [(r.Quantity, r.Price) for r in out.collect()] == [(1, Decimal("1.0000"))]


def test_noise_codes(spark):
    codes = ["POST", "D", "M", "C2", "BANK CHARGES", "85A", "8504", "85123A"]
    out = C.remove_noise(raw(spark, [line(code=c) for c in codes]))
    assert sorted(r.StockCode for r in out.collect()) == ["8504", "85123A"]


def test_description_mode_ties_and_missing(spark):
    rows = [line(code="A1", desc=d) for d in ("A", "A", "B", None)] + \
           [line(code="B2", desc=d) for d in ("B", "A", None)] + \
           [line(code="C3", desc=None), line(code="C3", desc="  ")] + \
           [line(code="D4", desc=d) for d in ("nan", "nan", "nan", "Lamp", None)]
    df = C.normalize_text(raw(spark, rows))
    out = C.fill_by_group_mode(df)
    got = {}
    for r in out.collect():
        got.setdefault(r.StockCode, []).append(r.Description)
    assert sorted(got["A1"]) == ["A", "A", "A", "B"]          # mode
    assert sorted(got["B2"]) == ["A", "A", "B"]               # tie -> smallest
    assert got["C3"] == ["Unknown", "Unknown"]               # nothing to take
    assert sorted(got["D4"]) == ["Lamp"] * 5                 # 'nan' is missing, never the mode


def test_clean_sales_end_to_end(spark):
    rows = [line(), line(), line(inv="C536379"), line(q=-2), line(code="POST"), line(desc=None, inv="536366"),
            line(code="22752", desc="set 7 babushka nesting boxes", q=2, p="7.6500", cust=None)]
    out = C.clean_sales(raw(spark, rows))
    res = {r.Invoice + "/" + r.StockCode: r for r in out.collect()}
    assert set(res) == {"536365/85123A", "536366/85123A", "536365/22752"}
    assert res["536366/85123A"].Description == "White Heart"
    assert res["536365/22752"].Description == "Set 7 Babushka Nesting Boxes"
    assert res["536365/22752"].HasCustomerID is False
    assert res["536365/22752"].TotalRevenue == Decimal("15.30")
    r = res["536365/85123A"]
    assert (r.Year, r.Month, r.YearMonth, r.DayOfWeek, r.DayOfWeekName, r.Hour, r.Quarter, r.WeekOfYear) == \
        (2010, 12, "2010-12", 2, "Wednesday", 8, 4, 48)
    assert out.columns[:8] == schemas.RAW_COLUMNS and len(out.columns) == 19


def test_null_and_baseline_audit(spark):
    rows = [line(), line(), line(cust=None), line(desc=None, q=-1), line(inv="C1", p="0.0000")]
    df = raw(spark, rows)
    nulls = {r.column_name: (r.null_count, r.null_pct) for r in C.null_audit(df).collect()}
    assert nulls["CustomerID"] == (1, 20.0) and nulls["Description"] == (1, 20.0) and nulls["Invoice"] == (0, 0.0)
    b = C.baseline_audit(df).collect()[0]
    assert (b.total_rows, b.duplicate_rows, b.missing_customer, b.missing_description, b.negative_quantity,
            b.nonpositive_price, b.cancelled_rows) == (5, 1, 1, 1, 1, 1, 1)


def test_empty_input(spark):
    out = C.clean_sales(raw(spark, []))
    assert out.count() == 0 and len(out.columns) == 19


def test_cleaning_is_idempotent(spark):
    rows = [line(), line(code=" 85123a"), line(inv="C1"), line(desc=None, inv="2"), line(desc="  SET OF 3 ", inv="3"),
            line(q=0), line(code="POST"), line(cust=None, inv="4")]
    once = C.clean_sales(raw(spark, rows))
    twice = C.clean_sales(once.select(*schemas.RAW_COLUMNS))
    key = lambda df: sorted(tuple(r) for r in df.select(*schemas.RAW_COLUMNS).collect())
    assert key(once) == key(twice)
