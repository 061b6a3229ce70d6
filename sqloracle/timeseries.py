"""DuckDB oracles of the window-based time-series keys (per-country monthly revenue)."""

from __future__ import annotations

from sqloracle.base import SALES_CLEANED, sround

SERIES = SALES_CLEANED + """,
m AS (SELECT Country, CAST(date_trunc('month', InvoiceDate) AS DATE) AS ds, sum(TotalRevenue) AS y
      FROM cleaned GROUP BY 1, 2),
b AS (SELECT Country, min(ds) AS lo, max(ds) AS hi FROM m GROUP BY 1),
cal AS (SELECT Country, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS ds
        FROM b),
series AS (SELECT cal.Country, cal.ds, CAST(coalesce(m.y, 0) AS DOUBLE) AS y FROM cal LEFT JOIN m USING (Country, ds))"""

_W = "OVER (PARTITION BY Country ORDER BY ds)"

SQL: dict[str, str] = {}

SQL["monthly_series"] = SERIES + " SELECT * FROM series"

SQL["first_difference"] = SERIES + f" SELECT Country, ds, y, y - lag(y, 1) {_W} AS diff FROM series"

SQL["train_test_split"] = SERIES + f"""
SELECT Country, ds, y,
       CASE WHEN row_number() {_W} <= floor(count(*) OVER (PARTITION BY Country) * 0.8) THEN 'train'
            ELSE 'test' END AS split
FROM series"""

# the eleven inner values of the centred window, from the first to the last
_AROUND = [f"lag(y, {k}) {_W}" for k in range(5, 0, -1)] + ["y"] + [f"lead(y, {k}) {_W}" for k in range(1, 6)]

DECOMP = SERIES + f""",
s AS (SELECT *, row_number() {_W} - 1 AS i, count(*) OVER (PARTITION BY Country) AS n,
             ((lag(y, 6) {_W} + lead(y, 6) {_W}) / 2 + ({" + ".join(_AROUND)})) / 12 AS ma_raw
      FROM series),
s2 AS (SELECT *, CASE WHEN i >= 6 AND i <= n - 7 THEN ma_raw END AS ma FROM s),
s3 AS (SELECT *,
         regr_slope(CASE WHEN i BETWEEN 6 AND 17 THEN ma END, CASE WHEN i BETWEEN 6 AND 17 THEN CAST(i AS DOUBLE) END)
           OVER (PARTITION BY Country) AS fs,
         regr_intercept(CASE WHEN i BETWEEN 6 AND 17 THEN ma END, CASE WHEN i BETWEEN 6 AND 17 THEN CAST(i AS DOUBLE) END)
           OVER (PARTITION BY Country) AS fi,
         regr_slope(CASE WHEN i BETWEEN n - 18 AND n - 7 THEN ma END, CASE WHEN i BETWEEN n - 18 AND n - 7 THEN CAST(i AS DOUBLE) END)
           OVER (PARTITION BY Country) AS bs,
         regr_intercept(CASE WHEN i BETWEEN n - 18 AND n - 7 THEN ma END, CASE WHEN i BETWEEN n - 18 AND n - 7 THEN CAST(i AS DOUBLE) END)
           OVER (PARTITION BY Country) AS bi
       FROM s2),
s4 AS (SELECT *, CASE WHEN n >= 24 THEN (CASE WHEN i < 6 THEN fi + fs * i WHEN i > n - 7 THEN bi + bs * i ELSE ma END) END
                   AS trend, i % 12 AS phase FROM s3),
s5 AS (SELECT *, avg(y - trend) OVER (PARTITION BY Country, phase) AS pm,
              count(*) OVER (PARTITION BY Country, phase) AS pc FROM s4),
s6 AS (SELECT *, pm - sum(pm / pc) OVER (PARTITION BY Country) / 12 AS seasonal FROM s5),
decomp AS (SELECT Country, ds, y AS observed, trend, seasonal, y - trend - seasonal AS resid FROM s6)"""

SQL["seasonal_decompose"] = DECOMP + f"""
SELECT Country, ds, observed, trend, seasonal, {sround('observed - trend - seasonal', 2)} AS resid
FROM (SELECT Country, ds, observed, {sround('trend', 2)} AS trend, {sround('seasonal', 2)} AS seasonal FROM decomp)"""

SQL["seasonal_index"] = DECOMP + f"""
SELECT Country, CAST(month(ds) AS INTEGER) AS month, {sround('avg(seasonal)', 2)} AS seasonal_effect
FROM decomp GROUP BY 1, 2"""

SQL["acf"] = SERIES + f""",
d0 AS (SELECT Country, ds, y - avg(y) OVER (PARTITION BY Country) AS dev FROM series),
d AS (SELECT Country, dev, {", ".join(f"lead(dev, {k}) {_W} AS l{k}" for k in range(1, 13))} FROM d0),
c AS (SELECT Country, [sum(dev * dev), {", ".join(f"sum(dev * l{k})" for k in range(1, 13))}] AS g FROM d GROUP BY Country)
SELECT Country, CAST(k AS INTEGER) AS lag, round(g[k + 1] / g[1], 6) AS acf FROM c, range(0, 13) t(k)"""

SQL["forecast_metrics"] = SERIES + f""",
p AS (SELECT Country, y AS actual, lag(y, 12) {_W} AS predicted FROM series),
mt AS (SELECT Country, avg(CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END) * 100 AS mape,
             avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
             count(*) AS n
      FROM p WHERE predicted IS NOT NULL GROUP BY Country)
SELECT Country, round(mape, 6) AS mape, round(mae, 2) AS mae, round(rmse, 2) AS rmse, n,
       round(100 - mape, 6) AS accuracy FROM mt"""

SQL["future_calendar"] = SERIES + """
SELECT Country, CAST(step AS INTEGER) AS step, CAST(last_ds + to_months(CAST(step AS INTEGER)) AS DATE) AS ds
FROM (SELECT Country, max(ds) AS last_ds FROM series GROUP BY Country), range(1, 7) t(step)"""

from sqloracle.ets import fit_ctes, forecast_select  # noqa: E402

_REC = SERIES.replace("WITH ", "WITH RECURSIVE ", 1)
SQL["ets_fit"] = _REC + "," + fit_ctes("series", "e") + " SELECT * EXCLUDE (season) FROM e_fit"
SQL["ets_season"] = _REC + "," + fit_ctes("series", "e") + """
SELECT Country, form, CAST(generate_subscripts(season, 1) - 1 AS INTEGER) AS slot, unnest(season) AS season
FROM e_fit WHERE form IN ('add', 'mul')"""
SQL["ets_forecast"] = _REC + "," + fit_ctes("series", "e") + forecast_select("e_fit", "6")

from sqloracle.base import sround as _sr  # noqa: E402

_SELECTION = _REC + "," + """
split AS (SELECT *, row_number() OVER (PARTITION BY Country ORDER BY ds) AS rn,
                 floor(count(*) OVER (PARTITION BY Country) * 0.8) AS cut FROM series),
train AS (SELECT Country, ds, y FROM split WHERE rn <= cut),
test AS (SELECT Country, ds, y, CAST(rn - cut AS INTEGER) AS step FROM split WHERE rn > cut),
horizon AS (SELECT Country, count(*) AS h FROM test GROUP BY Country),""" + fit_ctes("train", "tr") + """,
tr_fc AS (""" + forecast_select("(SELECT * FROM tr_fit JOIN horizon USING (Country))", "h") + """),
scored AS (SELECT f.Country, f.form, f.step, f.ds, t.y AS actual, f.forecast
           FROM tr_fc f JOIN test t ON t.Country = f.Country AND t.step = f.step AND t.ds = f.ds),
per_form AS (SELECT Country, form,
                    avg(CASE WHEN actual <> 0 THEN abs(actual - forecast) / abs(actual) * 100 END) AS mape
             FROM scored GROUP BY Country, form),
prio AS (SELECT * FROM (VALUES ('add', 0, 'add'), ('mul', 1, 'mul'), ('none', 2, 'none (trend only)'),
                               ('simple', 3, 'simple')) t(form, p, label)),
chosen AS (
  SELECT Country, form AS ets_form FROM (
    SELECT *, row_number() OVER (PARTITION BY Country
                                 ORDER BY CASE WHEN mape IS NULL OR isnan(mape) THEN 'Infinity'::DOUBLE ELSE mape END,
                                          p) AS r
    FROM per_form JOIN prio USING (form))
  WHERE r = 1),
evaluation AS (
  SELECT s.Country, s.ds, s.actual, s.forecast AS ets_pred,
         CASE WHEN s.actual <> 0 THEN abs(s.actual - s.forecast) / abs(s.actual) * 100 END AS ets_ape, s.form
  FROM scored s JOIN chosen c ON c.Country = s.Country AND c.ets_form = s.form),""" + fit_ctes("series", "fu") + """,
future AS (""" + forecast_select("(SELECT f.* FROM fu_fit f JOIN chosen c ON c.Country = f.Country AND c.ets_form = f.form)",
                                 "6") + """)
"""

SQL["model_selection"] = _SELECTION + """
SELECT Country, ets_form, CASE WHEN ets_form IS NOT NULL THEN 'ets' END AS winner,
       CASE WHEN ets_form IS NULL THEN 'no fit' WHEN f.form IS NULL THEN 'no refit' ELSE 'ok' END AS status
FROM (SELECT DISTINCT Country FROM series) LEFT JOIN chosen USING (Country)
LEFT JOIN fu_fit f USING (Country) WHERE f.form IS NULL OR f.form = ets_form"""
SQL["model_evaluation"] = _SELECTION + """
SELECT Country, strftime(ds, '%Y-%m') AS YearMonth, actual AS Actual, ets_pred AS ETS_Pred, ets_ape AS ETS_APE
FROM evaluation"""
SQL["model_summary"] = _SELECTION + f"""
SELECT Country, Model, {_sr('mape', 2)} AS MAPE, {_sr('100 - mape', 1)} AS Accuracy, {_sr('mae', 0)} AS MAE,
       {_sr('rmse', 0)} AS RMSE
FROM (SELECT e.Country, 'Holt-Winters (' || p.label || ')' AS Model, avg(e.ets_ape) AS mape,
             avg(abs(e.actual - e.ets_pred)) AS mae, sqrt(avg((e.actual - e.ets_pred) * (e.actual - e.ets_pred))) AS rmse
      FROM evaluation e JOIN prio p USING (form) GROUP BY e.Country, p.label)"""
SQL["revenue_forecast"] = _SELECTION + f"""
SELECT f.Country, strftime(f.ds, '%Y-%m') AS YearMonth, {_sr('f.forecast', 2)} AS ForecastRevenue,
       {_sr('f.lower', 2)} AS Lower_80CI, {_sr('f.upper', 2)} AS Upper_80CI,
       'Holt-Winters (' || p.label || ')' AS ModelUsed
FROM future f JOIN prio p USING (form)"""
# the same statement over one series named after no country
SQL["revenue_forecast_total"] = SQL["revenue_forecast"].replace(SERIES.replace("WITH ", "WITH RECURSIVE ", 1), SERIES.replace(
    "WITH ", "WITH RECURSIVE ", 1).replace("SELECT Country, CAST(date_trunc", "SELECT 'total' AS Country, CAST(date_trunc")
    ).replace("SELECT f.Country, strftime", "SELECT strftime")

# PACF by Durbin-Levinson on biased autocovariances: a recursive CTE over the lag.
SQL["pacf"] = _REC + """,
d AS (SELECT Country, ds, y - avg(y) OVER (PARTITION BY Country) AS dev,
             count(*) OVER (PARTITION BY Country) AS n FROM series),
lagged AS (SELECT Country, n, dev, """ + ", ".join(f"lead(dev, {k}) OVER (PARTITION BY Country ORDER BY ds) AS l{k}"
                                                    for k in range(1, 13)) + """ FROM d),
acov AS (SELECT Country, [sum(dev * dev) / any_value(n), """ + ", ".join(f"sum(dev * l{k}) / any_value(n)"
                                                                           for k in range(1, 13)) + """] AS g
         FROM lagged GROUP BY Country),
dl(Country, g, k, phi, v) AS (
  SELECT Country, g, 1, [g[2] / g[1]], g[1] * (1 - (g[2] / g[1]) * (g[2] / g[1])) FROM acov
  UNION ALL
  SELECT Country, g, k + 1,
         list_concat(list_transform(phi, lambda p, j: p - a * phi[k - j + 1]), [a]),
         v * (1 - a * a)
  FROM (SELECT *, (g[k + 2] - list_sum(list_transform(phi, lambda p, j: p * g[k - j + 2]))) / v AS a FROM dl)
  WHERE k < 12)
SELECT Country, 0 AS lag, 1.0::DOUBLE AS pacf FROM acov
UNION ALL
SELECT Country, CAST(k AS INTEGER) AS lag, round(phi[k], 6) AS pacf FROM dl"""
