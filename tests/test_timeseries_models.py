import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillspark.operators import arima as AR
from tillspark.operators import diagnostics as DG
from tillspark.operators import ets as ETS
from tillspark.operators import timeseries as TS
from tillspark.plans.forecasting import model_selection


def months(start, n):
    y, m = start
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out


def series_df(spark, values, key="S", start=(2009, 12)):
    rows = [(key, d, float(v)) for d, v in zip(months(start, len(values)), values)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_monthly_series_fills_gaps(spark):
    rows = [("A", dt.datetime(2011, 1, 3), 5.0), ("A", dt.datetime(2011, 3, 9), 7.0), ("A", dt.datetime(2011, 3, 1), 1.0)]
    lines = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    got = sorted((r.ds, r.y) for r in TS.monthly_series(lines, "k", ts="ts", value="v").collect())
    assert got == [(dt.date(2011, 1, 1), 5.0), (dt.date(2011, 2, 1), 0.0), (dt.date(2011, 3, 1), 8.0)]


def test_split_25_is_20_5(spark):
    s = TS.train_test_split(series_df(spark, range(25)), "k")
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 20, "test": 5}


def test_decomposition_adds_up_and_linear_trend(spark):
    n = 36
    seasonal = [10 * math.sin(2 * math.pi * i / 12) for i in range(n)]
    values = [100 + 2 * i + seasonal[i] for i in range(n)]
    d = TS.seasonal_decompose(series_df(spark, values), "k").orderBy("ds").collect()
    for r in d:
        assert abs(r.observed - (r.trend + r.seasonal + r.resid)) < 1e-9
    # a pure linear trend plus a zero-mean 12-month pattern: the MA trend is the line
    trend = [r.trend for r in d]
    assert max(abs(t - (100 + 2 * i)) for i, t in enumerate(trend)) < 1e-6
    short = TS.seasonal_decompose(series_df(spark, range(23)), "k").collect()
    assert all(r.trend is None for r in short)


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=40).cumsum()
    got = {r.lag: r.acf for r in TS.acf(series_df(spark, v), "k", lags=5).collect()}
    x = v - v.mean()
    want = [float(x[: len(x) - k] @ x[k:] / (x @ x)) for k in range(6)]
    assert all(abs(got[k] - want[k]) < 1e-12 for k in range(6))


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([("g", 10.0, 10.0), ("g", 0.0, 3.0), ("h", 4.0, 5.0)], "k string, actual double, predicted double")
    m = {r.k: r for r in TS.forecast_metrics(df, "k").collect()}
    assert m["g"].mape == 0.0 and m["g"].accuracy == 100.0     # the zero actual is left out of MAPE
    assert m["g"].mae == 1.5 and abs(m["g"].rmse - math.sqrt(4.5)) < 1e-12
    assert m["h"].mape == 25.0


def test_future_calendar(spark):
    got = [r.ds for r in TS.future_calendar(series_df(spark, range(5)), "k", h=3).orderBy("step").collect()]
    assert got == [dt.date(2010, 5, 1), dt.date(2010, 6, 1), dt.date(2010, 7, 1)]


def test_ets_engines_agree(spark):
    rng = np.random.default_rng(7)
    vals = [200 + 3 * i + 30 * math.sin(2 * math.pi * i / 12) + rng.normal(0, 5) for i in range(30)]
    s = series_df(spark, vals)
    a = {r.form: r for r in ETS.ets_fit(s, ["k"], engine="numpy").collect()}
    b = {r.form: r for r in ETS.ets_fit(s, ["k"], engine="sql").collect()}
    assert set(a) == set(b) == set(ETS.FORMS)
    for f in ETS.FORMS:
        for c in ("alpha", "beta", "gamma", "sse", "level", "trend", "resid_std"):
            assert a[f][c] == pytest.approx(b[f][c], rel=1e-12, abs=1e-9), (f, c)


def test_ets_linear_series_forecasts_the_line(spark):
    vals = [50 + 4 * i for i in range(20)]
    fits = ETS.ets_fit(series_df(spark, vals), ["k"], forms=["none"])
    fc = ETS.ets_forecast(fits, ["k"], h=3).orderBy("step").collect()
    assert [round(r.forecast, 9) for r in fc] == [50 + 4 * 20, 50 + 4 * 21, 50 + 4 * 22]
    assert all(r.lower == r.forecast == r.upper for r in fc)   # zero residual spread


def test_css_recovers_ar1():
    rng = np.random.default_rng(11)
    e = rng.normal(size=400)
    y = np.zeros(400)
    for t in range(1, 400):
        y[t] = 0.6 * y[t - 1] + e[t]
    params, sse, n, status = AR.fit_css(y, AR.Order(1, 0, 0, 0, 0, 0, 12))
    assert status == "ok" and abs(params[0] - 0.6) < 0.08
    params, _, _, _ = AR.fit_css(y + np.r_[0, e[:-1]] * 0.0, AR.Order(1, 0, 1, 0, 0, 0, 12))
    assert abs(params[0] - 0.6) < 0.15


def test_css_recovers_ma1():
    rng = np.random.default_rng(5)
    e = rng.normal(size=400)
    y = e + np.r_[0, 0.5 * e[:-1]]
    params, _, _, status = AR.fit_css(y, AR.Order(0, 0, 1, 0, 0, 0, 12))
    assert status == "ok" and abs(params[0] - 0.5) < 0.1


def test_sarima_forecast_and_short_series(spark):
    rng = np.random.default_rng(2)
    vals = [1000 + 10 * i + 100 * math.sin(2 * math.pi * i / 12) + rng.normal(0, 5) for i in range(48)]
    out = AR.sarima_forecast(series_df(spark, vals), ["k"], h=6).orderBy("step").collect()
    assert len(out) == 6 and all(r.status == "ok" and r.lower < r.forecast < r.upper for r in out)
    widths = [r.upper - r.lower for r in out]
    assert widths == sorted(widths)                      # uncertainty grows with the horizon
    short = AR.sarima_forecast(series_df(spark, range(10)), ["k"]).collect()
    assert len(short) == 1 and short[0].status == "too short"


def test_adf_and_pacf():
    rng = np.random.default_rng(1)
    noise = rng.normal(size=200)
    walk = noise.cumsum()
    assert DG.adf(noise)[1] < 0.01
    assert DG.adf(walk)[1] > 0.05
    assert DG.adf_pvalue(-1.0) > DG.adf_pvalue(-3.0) > DG.adf_pvalue(-5.0)
    shocks = rng.normal(size=600)
    ar = np.zeros(600)
    for t in range(1, 600):
        ar[t] = 0.7 * ar[t - 1] + shocks[t]
    p = DG.pacf_yw(ar, 5)
    assert abs(p[1] - 0.7) < 0.1 and max(abs(p[2:])) < 0.15
    # Durbin-Levinson = last coefficient of the Yule-Walker system solved directly
    x = ar - ar.mean()
    acov = np.array([x[: len(x) - k] @ x[k:] / len(x) for k in range(6)])
    for k in range(1, 6):
        toe = np.array([[acov[abs(i - j)] for j in range(k)] for i in range(k)])
        assert abs(np.linalg.solve(toe, acov[1:k + 1])[-1] - p[k]) < 1e-10


def test_model_selection_tables(spark):
    rng = np.random.default_rng(4)
    vals = [500 + 5 * i + 50 * math.sin(2 * math.pi * i / 12) + rng.normal(0, 3) for i in range(36)]
    t = model_selection(series_df(spark, vals), ["k"], include_sarima=True)
    ev = t["evaluation"].collect()
    assert len(ev) == 36 - int(36 * 0.8)
    summ = {r.Model.split(" ")[0]: r for r in t["summary"].collect()}
    assert set(summ) == {"SARIMA", "Holt-Winters"}
    fc = t["forecast"].collect()
    assert len(fc) == 6 and len({r.ModelUsed for r in fc}) == 1
    sel = t["selection"].collect()[0]
    s_mape, e_mape = summ["SARIMA"].MAPE, summ["Holt-Winters"].MAPE
    assert sel.winner == ("sarima" if s_mape <= e_mape else "ets") or abs(s_mape - e_mape) < 0.01


def test_inventory_risk_forecast_flags_rising_demand(spark):
    from decimal import Decimal

    from tillspark import schemas
    from tillspark.operators import warehouse as WH
    from tillspark.operators.features import add_features
    from tillspark.plans.forecasting import inventory_risk_forecast
    rows = []
    for i, d in enumerate(months((2009, 1), 30)):
        ts = dt.datetime(d.year, d.month, 3, 10)
        rows.append((f"U{i}", "UP001", "Rising", 10 + 3 * i, ts, Decimal("1.0000"), 1, "EIRE"))
        rows.append((f"D{i}", "DN001", "Falling", 200 - 5 * i, ts, Decimal("1.0000"), 2, "EIRE"))
    cleaned = add_features(spark.createDataFrame(rows, schemas.RAW_SALES))
    w = WH.build_warehouse(cleaned)
    got = {r.stock_code: r for r in inventory_risk_forecast(w, cleaned).collect()}
    assert got["UP001"].stockout_flag is True and got["UP001"].forecast_qty > got["UP001"].avg_monthly_qty
    assert got["DN001"].stockout_flag is False


def test_order_search_stepwise_vs_exhaustive(spark):
    rng = np.random.default_rng(8)
    vals = [1000 + 8 * i + 80 * math.sin(2 * math.pi * i / 12) + rng.normal(0, 10) for i in range(60)]
    s = series_df(spark, vals)
    small = dict(max_p=1, max_q=1, max_P=1, max_Q=1)
    step = AR.sarima_order_search(s, ["k"], **small).collect()[0]
    full = AR.sarima_order_search(s, ["k"], stepwise=False, **small).collect()[0]
    assert full.candidates == 16 and step.candidates <= 16
    assert full.aic <= step.aic + 1e-9
    assert step.sd == 1 and 0 <= step.p <= 1 and 0 <= step.sq <= 1


def test_decomposition_keeps_small_values(spark):
    from tillspark.operators.timeseries import seasonal_decompose
    rows = seasonal_decompose(series_df(spark, [0.001 * (i + 1) for i in range(36)]), ["k"]).orderBy("ds").collect()
    assert all(abs(r.trend - 0.001 * (i + 1)) < 1e-12 for i, r in enumerate(rows))


def test_one_total_series_and_short_series(spark):
    from tillspark.plans.forecasting import model_selection
    total = model_selection(series_df(spark, [100.0 + 3 * i for i in range(20)]).drop("k"), [])
    assert total["forecast"].count() == 6 and total["selection"].first().status == "ok"
    both = series_df(spark, range(1, 21)).unionByName(
        series_df(spark, [5.0, 6.0]).withColumn("k", F.lit("short")))
    status = {r.k: r.status for r in model_selection(both, ["k"])["selection"].collect()}
    assert status.pop("short") == "no fit" and set(status.values()) == {"ok"}


def test_batched_fits_equal_single_ones_and_short_series_get_a_shorter_cycle(spark):
    import datetime as dt
    from tillspark.operators import ets as ETS
    import random
    rng = random.Random(8)

    def month(i):
        return dt.date(2010 + i // 12, 1 + i % 12, 1)
    lengths = {f"k{j}": n for j, n in enumerate([2, 3, 4, 7, 14, 14, 23, 24, 30, 30, 41])}
    rows = [(k, month(i), 100 + 10 * ((i % 7) - 3) + rng.random()) for k, n in lengths.items() for i in range(n)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    many = {(r.k, r.form): r for r in ETS.ets_fit(df, ["k"]).collect()}
    for k in ("k4", "k5", "k8", "k9"):
        for r in ETS.ets_fit(df.filter(df.k == k), ["k"]).collect():
            assert many[(k, r.form)] == r
    sql = {(r.k, r.form): r for r in ETS.ets_fit(df.filter("k IN ('k7', 'k8', 'k10')"), ["k"], engine="sql").collect()}
    assert all(many[key].sse == r.sse and many[key].season == r.season for key, r in sql.items()) and len(sql) == 12
    cycles = {k: {f: len(many[(k, f)].season) for f in ("add", "none") if (k, f) in many} for k in lengths}
    assert cycles["k0"] == {} and cycles["k1"] == {"none": 0} and cycles["k2"] == {"add": 2, "none": 0}
    assert cycles["k4"]["add"] == 7 and cycles["k6"]["add"] == 11 and cycles["k7"]["add"] == 12
    ahead = [r for r in ETS.ets_forecast(ETS.ets_fit(df.filter("k = 'k4'"), ["k"]), ["k"], 7).collect() if r.form == "add"]
    seasonal = [10 * (((14 + i) % 7) - 3) for i in range(7)]
    mean = sum(r.forecast for r in ahead) / 7
    assert all(abs((r.forecast - mean) - s) < 12 for r, s in zip(sorted(ahead, key=lambda r: r.step), seasonal))
