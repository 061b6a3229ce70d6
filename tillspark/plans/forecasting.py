"""Forecasting plans: series, diagnostics, model fits, selection and report tables.

``entry_queries`` registers the keys that run on the test data: per-country monthly
revenue series built from the ``sales`` adapter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillspark.operators import timeseries as TS
from tillspark.operators.features import add_features
from tillspark.sources import testdata as TD

SERIES_KEYS = ["Country"]


def country_series(spark: SparkSession, sf: str) -> DataFrame:
    return TS.monthly_series(add_features(TD.sales(spark, sf)), SERIES_KEYS)


def _r(df: DataFrame, cols: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in cols.items()})


def _seasonal_naive_metrics(spark: SparkSession, sf: str) -> DataFrame:
    s = country_series(spark, sf)
    w = Window.partitionBy(*SERIES_KEYS).orderBy("ds")
    p = s.select(*SERIES_KEYS, F.col("y").alias("actual"), F.lag("y", 12).over(w).alias("predicted")) \
        .filter(F.col("predicted").isNotNull())
    m = TS.forecast_metrics(p, SERIES_KEYS)
    return _r(m, {"mape": 6, "mae": 2, "rmse": 2, "accuracy": 6})


def _decomposition_in_cents(series: DataFrame) -> DataFrame:
    """Components in cents; the residual is what the rounded trend and season leave."""
    d = _r(TS.seasonal_decompose(series, SERIES_KEYS), {"trend": 2, "seasonal": 2})
    return d.withColumn("resid", F.round(F.col("observed") - F.col("trend") - F.col("seasonal"), 2))


def entry_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "monthly_series": country_series,
        "first_difference": lambda s, sf: TS.first_difference(country_series(s, sf), SERIES_KEYS),
        "train_test_split": lambda s, sf: TS.train_test_split(country_series(s, sf), SERIES_KEYS),
        "seasonal_decompose": lambda s, sf: _decomposition_in_cents(country_series(s, sf)),
        "seasonal_index": lambda s, sf: _r(TS.seasonal_index(
            TS.seasonal_decompose(country_series(s, sf), SERIES_KEYS), SERIES_KEYS), {"seasonal_effect": 2}),
        "acf": lambda s, sf: _r(TS.acf(country_series(s, sf), SERIES_KEYS), {"acf": 6}),
        "forecast_metrics": _seasonal_naive_metrics,
        "future_calendar": lambda s, sf: TS.future_calendar(country_series(s, sf), SERIES_KEYS),
    }
    q.update(forecast_entry_queries())
    return q


# ---------------------------------------------------------------------------
# Model selection (I11) and the report tables
# ---------------------------------------------------------------------------

from tillspark import schemas  # noqa: E402
from tillspark.operators import arima as AR  # noqa: E402
from tillspark.operators import diagnostics as DG  # noqa: E402
from tillspark.operators import ets as ETS  # noqa: E402

def _priority(form):
    return F.create_map(*[x for i, f in enumerate(ETS.FORMS) for x in (F.lit(f), F.lit(i))])[form]


def _label(form):
    return F.create_map(*[x for f, lab in ETS.LABELS.items() for x in (F.lit(f), F.lit(lab))])[form]


def _holdout(series: DataFrame, keys: list[str], ratio: float):
    split = TS.train_test_split(series, keys, ratio)
    train = split.filter(F.col("split") == "train").drop("split")
    w = Window.partitionBy(*keys).orderBy("ds")
    test = (split.filter(F.col("split") == "test").drop("split")
            .withColumn("step", F.row_number().over(w)))
    horizon = test.groupBy(*keys).agg(F.count(F.lit(1)).alias("_h"))
    return train, test, horizon


def _ape(actual: str, pred: str):
    a, p = F.col(actual), F.col(pred)
    return F.when(a != 0, F.abs(a - p) / F.abs(a) * 100)


def model_selection(series: DataFrame, keys: Sequence[str], ratio: float = schemas.TRAIN_RATIO,
                    h: int = schemas.HORIZON, forms: Sequence[str] = ETS.FORMS, rule: str = "best",
                    include_sarima: bool = False, order: AR.Order = AR.Order()) -> dict[str, DataFrame]:
    """Hold-out evaluation, model choice, refit on the full history and forecast.

    ETS form: ``rule='best'`` takes the lowest test MAPE (notebook rule), ``'first'`` the
    first form that fits in the order add, mul, none, simple (script rule). With
    ``include_sarima`` the SARIMA order competes and wins ties (MAPE <=). Returns
    ``selection``, ``evaluation``, ``summary`` and ``forecast`` tables.

    No ``keys`` means one total series. ``selection`` has a row for every series: its status
    is ``no fit`` where no form fits the training months (fewer than three), ``no refit``
    where the chosen form fails on the full history, else ``ok``; only ``ok`` series have
    forecast rows.
    """
    keys = list(keys)
    if not keys:
        one = F.substring(F.date_format("ds", "yyyy"), 1, 0)  # empty, but no literal: that would turn the joins into products
        tables = model_selection(series.withColumn("_total", one), ["_total"], ratio, h, forms, rule, include_sarima, order)
        return {name: table.drop("_total") for name, table in tables.items()}
    train, test, horizon = _holdout(series, keys, ratio)
    fits = ETS.ets_fit(train, keys, forms)
    fc = ETS.ets_forecast(fits.join(horizon, keys), keys, "_h")
    scored = fc.join(test.select(*keys, "step", "ds", F.col("y").alias("actual")), [*keys, "step", "ds"])
    per_form = scored.groupBy(*keys, "form").agg(
        F.avg(_ape("actual", "forecast")).alias("mape"))
    rank = (F.struct(F.coalesce(F.when(~F.isnan("mape"), F.col("mape")), F.lit(float("inf"))).alias("m"),
                     _priority(F.col("form")).alias("p"))
            if rule == "best" else F.struct(_priority(F.col("form")).alias("p")))
    chosen = per_form.groupBy(*keys).agg(F.min_by("form", rank).alias("ets_form"))
    ets_pred = scored.join(chosen.withColumnRenamed("ets_form", "form"), [*keys, "form"]) \
        .select(*keys, "step", "ds", "actual", F.col("forecast").alias("ets_pred"), "form")

    evaluation = ets_pred.withColumn("ets_ape", _ape("actual", "ets_pred"))
    models = [("ets", F.concat(F.lit("Holt-Winters ("), _label(F.col("form")), F.lit(")")))]
    if include_sarima:
        s_fc = AR.sarima_forecast(train.join(horizon, keys), keys, order, h="_h")
        s_pred = s_fc.filter(F.col("status") == "ok").select(*keys, "step", F.col("forecast").alias("sarima_pred"))
        evaluation = evaluation.join(s_pred, [*keys, "step"], "left") \
            .withColumn("sarima_ape", _ape("actual", "sarima_pred"))
        models.insert(0, ("sarima", F.lit("SARIMA")))

    def metrics(prefix: str, name) -> DataFrame:
        a, p = F.col("actual"), F.col(f"{prefix}_pred")
        return evaluation.filter(p.isNotNull()).groupBy(*keys).agg(
            F.first(name).alias("Model"), F.avg(F.col(f"{prefix}_ape")).alias("_mape"),
            F.avg(F.abs(a - p)).alias("_mae"), F.sqrt(F.avg((a - p) * (a - p))).alias("_rmse"))

    summary = None
    for prefix, name in models:
        part = metrics(prefix, name).withColumn("_kind", F.lit(prefix))
        summary = part if summary is None else summary.unionByName(part)

    # winner: SARIMA when its MAPE is <= the ETS one (NaN MAPE loses)
    by_kind = summary.groupBy(*keys).agg(
        F.min_by("_kind", F.struct(F.coalesce(F.when(~F.isnan("_mape"), F.col("_mape")), F.lit(float("inf"))),
                                   F.when(F.col("_kind") == "sarima", 0).otherwise(1))).alias("winner"))
    picked = chosen.join(by_kind, keys)

    # refit the chosen form on the full history and forecast h months
    full_fits = ETS.ets_fit(series.join(chosen.withColumnRenamed("ets_form", "form"), keys), keys, forms, form_column="form")
    refits = full_fits.select(*keys, F.lit(True).alias("_refit"))
    status = F.when(F.col("ets_form").isNull(), "no fit").when(F.col("_refit").isNull(), "no refit").otherwise("ok")
    selection = (series.select(*keys).distinct().join(picked, keys, "left").join(refits, keys, "left")
                 .withColumn("status", status).drop("_refit"))
    ets_future = ETS.ets_forecast(full_fits, keys, h).join(selection.filter(F.col("winner") == "ets"), keys) \
        .select(*keys, "ds", "forecast", "lower", "upper",
                F.concat(F.lit("Holt-Winters ("), _label(F.col("form")), F.lit(")")).alias("model"))
    future = ets_future
    if include_sarima:
        won = selection.filter(F.col("winner") == "sarima").select(*keys)
        s_future = AR.sarima_forecast(series.join(won, keys, "left_semi"), keys, order, h).filter(F.col("status") == "ok") \
            .select(*keys, "ds", "forecast", "lower", "upper", F.lit("SARIMA").alias("model"))
        future = future.unionByName(s_future)

    ev_cols = [*keys, F.date_format("ds", "yyyy-MM").alias("YearMonth"), F.col("actual").alias("Actual")]
    if include_sarima:
        ev_cols += [F.col("sarima_pred").alias("SARIMA_Pred")]
    ev_cols += [F.col("ets_pred").alias("ETS_Pred")]
    if include_sarima:
        ev_cols += [F.col("sarima_ape").alias("SARIMA_APE")]
    ev_cols += [F.col("ets_ape").alias("ETS_APE")]
    return {
        "selection": selection,
        "evaluation": evaluation.select(*ev_cols),
        "summary": summary.select(*keys, "Model", F.round("_mape", 2).alias("MAPE"),
                                  F.round(100 - F.col("_mape"), 1).alias("Accuracy"),
                                  F.round("_mae", 0).alias("MAE"), F.round("_rmse", 0).alias("RMSE")),
        "forecast": future.select(*keys, F.date_format("ds", "yyyy-MM").alias("YearMonth"),
                                  F.round("forecast", 2).alias("ForecastRevenue"),
                                  F.round("lower", 2).alias("Lower_80CI"), F.round("upper", 2).alias("Upper_80CI"),
                                  F.col("model").alias("ModelUsed")),
    }


def _inventory_risk_forecast(spark: SparkSession, sf: str) -> DataFrame:
    from tillspark.operators.warehouse import build_warehouse
    cleaned = add_features(TD.sales(spark, sf))
    w = build_warehouse(cleaned, TD.country_regions(spark, sf))
    # test-scale thresholds, as for the other risk keys (a part sells ~30 units a month)
    return inventory_risk_forecast(w, cleaned, high=35, medium=30)


def forecast_entry_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    k = SERIES_KEYS

    def sel(part: str):
        return lambda s, sf: model_selection(country_series(s, sf), k)[part]

    return {
        "ets_fit": lambda s, sf: ETS.ets_fit(country_series(s, sf), k).drop("season"),
        "ets_season": lambda s, sf: ETS.ets_fit(country_series(s, sf), k, ("add", "mul")).select(
            *k, "form", F.posexplode("season").alias("slot", "season")),
        "ets_forecast": lambda s, sf: ETS.ets_forecast(ETS.ets_fit(country_series(s, sf), k), k),
        "model_selection": sel("selection"),
        "model_evaluation": sel("evaluation"),
        "model_summary": sel("summary"),
        "revenue_forecast": sel("forecast"),
        "revenue_forecast_total": lambda s, sf: model_selection(
            TS.monthly_series(add_features(TD.sales(s, sf))), [])["forecast"],
        "pacf": lambda s, sf: _r(DG.pacf(country_series(s, sf), k), {"pacf": 6}),
        "inventory_risk_forecast": _inventory_risk_forecast,
    }


def product_demand_forecast(cleaned: DataFrame, keys: Sequence[str] = ("StockCode",), value: str = "Quantity",
                            h: int = 3, forms: Sequence[str] = ("add", "none", "simple")) -> DataFrame:
    """Mean forecast quantity of the next ``h`` months per product.

    Zero-filled monthly quantity series per product, ETS model selection per series
    (all products in parallel, one group each), mean of the h-month forecast.
    """
    keys = list(keys)
    series = TS.monthly_series(cleaned, keys, value=value)
    fc = model_selection(series, keys, h=h, forms=forms)["forecast"]
    return fc.groupBy(*keys).agg(F.avg("ForecastRevenue").alias("forecast_qty"))


def inventory_risk_forecast(w, cleaned: DataFrame, high: float = schemas.RISK_HIGH,
                            medium: float = schemas.RISK_MEDIUM, h: int = 3) -> DataFrame:
    """Inventory risk with the forecast quantity and stock-out flag filled (W9, S16):
    stock-out when the forecast monthly demand exceeds the average monthly quantity."""
    from tillspark.operators.warehouse import inventory_risk
    fq = product_demand_forecast(cleaned, h=h).select(F.col("StockCode").alias("stock_code"), "forecast_qty")
    return inventory_risk(w, high, medium, forecast_qty=fq)
