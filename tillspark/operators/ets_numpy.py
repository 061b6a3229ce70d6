"""Vector form of the Holt-Winters grid search, many series in one call.

Spark gathers each series into one row (a calendar of months, so a short array). Of a batch of
such rows, those of one length form a matrix, and all grid candidates of all of its series
advance together, month by month, as NumPy arrays. Operation order matches the SQL fold in
``ets.py``, so each series gets the numbers that it would get alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


FORMS = ("add", "mul", "none", "simple")
SEASONAL = ("add", "mul")
FINE_STEPS = (0.1, 0.02)  # each search is around the best candidate of the one before
SERIES_AT_ONCE = 256


def _seq_mean(v: np.ndarray) -> np.ndarray:
    """Mean of each row, added from the first to the last value."""
    acc = np.zeros(len(v))
    for x in v.T:
        acc = acc + x
    return acc / v.shape[1]


def _candidates(form: str, values: Sequence[float]) -> np.ndarray:
    betas = [0.0] if form == "simple" else list(values)
    gammas = list(values) if form in SEASONAL else [0.0]
    return np.array(list(product([float(a) for a in values], [float(b) for b in betas],
                                 [float(g) for g in gammas])), dtype=np.float64)


def _refined(form: str, best: np.ndarray, step: float) -> np.ndarray:
    d = [-step, 0.0, step]
    clip = lambda v: min(max(v, 0.01), 0.99)
    betas = [0.0] if form == "simple" else d
    gammas = d if form in SEASONAL else [0.0]
    rows = []
    for da, db, dg in product(d, betas, gammas):
        rows.append((clip(best[0] + da), 0.0 if form == "simple" else clip(best[1] + db),
                     clip(best[2] + dg) if form in SEASONAL else 0.0))
    return np.array(rows, dtype=np.float64)


def _run(form: str, y: np.ndarray, m: int, cand: np.ndarray):
    """Fold the candidates (series, candidate, parameter) over the series (series, month);
    returns level, trend, season, steps and error sums of each series and candidate."""
    a, b_, g = cand[:, :, 0], cand[:, :, 1], cand[:, :, 2]
    if form in SEASONAL:
        l0 = _seq_mean(y[:, :m])
        b0 = (_seq_mean(y[:, m:2 * m]) - l0) / m
        s0 = (y[:, :m] - l0[:, None]) if form == "add" else (y[:, :m] / l0[:, None])
        vals = y
    else:
        l0 = y[:, 0]
        b0 = y[:, 1] - y[:, 0] if form == "none" else np.zeros(len(y))
        vals = y[:, 1:]
    lv = np.repeat(l0[:, None], cand.shape[1], axis=1)
    bv = np.repeat(b0[:, None], cand.shape[1], axis=1)
    s = np.repeat(s0.T[:, :, None], cand.shape[1], axis=2) if form in SEASONAL else None  # slot, series, candidate
    sse, se = np.zeros_like(lv), np.zeros_like(lv)
    for t in range(vals.shape[1]):
        x = vals[:, t, None]
        if form in SEASONAL:
            sv = s[t % m].copy()
        if form == "add":
            yhat = lv + bv + sv
            l_new = a * (x - sv) + (1 - a) * (lv + bv)
        elif form == "mul":
            yhat = (lv + bv) * sv
            l_new = a * (x / sv) + (1 - a) * (lv + bv)
        elif form == "none":
            yhat = lv + bv
            l_new = a * x + (1 - a) * (lv + bv)
        else:
            yhat = lv
            l_new = a * x + (1 - a) * lv
        b_new = bv if form == "simple" else b_ * (l_new - lv) + (1 - b_) * bv
        if form in SEASONAL:
            s[t % m] = (g * (x - l_new) if form == "add" else g * (x / l_new)) + (1 - g) * sv
        e = x - yhat
        lv, bv = l_new, b_new
        sse = sse + e * e
        se = se + e
    return lv, bv, s, vals.shape[1], sse, se


def _best(cand: np.ndarray, sse: np.ndarray) -> np.ndarray:
    """Of each series the lowest SSE, ties to the smallest (alpha, beta, gamma); NaN never wins."""
    key = np.where(np.isnan(sse), np.inf, sse)
    order = np.lexsort((cand[:, :, 2], cand[:, :, 1], cand[:, :, 0], key), axis=1)
    return order[:, 0]


def _fit_many(y: np.ndarray, form: str, period: int, coarse, refine: bool) -> dict[str, list]:
    """The best fit of a form to each of the series (series, month), all of one length."""
    each = np.arange(len(y))
    with np.errstate(all="ignore"):
        cand = np.broadcast_to(_candidates(form, coarse), (len(y), *_candidates(form, coarse).shape))
        lv, bv, s, steps, sse, se = _run(form, y, period, cand)
        i = _best(cand, sse)
        for step in FINE_STEPS if refine else ():
            cand = np.stack([_refined(form, best, step) for best in cand[each, i]])
            lv, bv, s, steps, sse, se = _run(form, y, period, cand)
            i = _best(cand, sse)
        sse, se, best = sse[each, i], se[each, i], cand[each, i]
        var = sse / steps - (se / steps) ** 2
        std = np.sqrt(np.maximum(var, 0.0))
    seasons = s[:, each, i].T.tolist() if s is not None else [[]] * len(y)
    return {"form": [form] * len(y), "alpha": best[:, 0], "beta": best[:, 1], "gamma": best[:, 2], "sse": sse, "resid_std": std,
            "level": lv[each, i], "trend": bv[each, i], "season": seasons, "steps": [steps] * len(y)}


def _fit_batch(pdf: pd.DataFrame, keys: list[str], forms, period: int, coarse, refine: bool) -> pd.DataFrame:
    """Fits of a batch of series (one row each, values in ``_y``): those of one length together."""
    out = []
    for n, rows in pdf.groupby("n", sort=False):
        y = np.array(rows["_y"].tolist(), dtype=np.float64).reshape(len(rows), n)
        m = min(period, int(n) // 2)  # two full cycles at least: short series get a shorter one
        for form in forms:
            mine = (rows["_form"] == form).to_numpy() if "_form" in rows else np.ones(len(rows), bool)
            if n < 3 or (form in SEASONAL and m < 2) or not mine.any():
                continue
            fits = pd.DataFrame(_fit_many(y[mine], form, m, coarse, refine))
            names = rows.loc[mine, [*keys, "n", "last_ds"]].reset_index(drop=True)
            fits = pd.concat([names, fits], axis=1)
            out.append(fits[np.isfinite(fits["sse"])])
    cols = [*keys, "form", "alpha", "beta", "gamma", "sse", "resid_std", "level", "trend", "season", "steps", "n", "last_ds"]
    return pd.concat(out)[cols] if out else pd.DataFrame(columns=cols)


def fit_schema(series: DataFrame, keys: list[str]) -> T.StructType:
    key_fields = [series.schema[k] for k in keys]
    return T.StructType(key_fields + [
        T.StructField("form", T.StringType()), T.StructField("alpha", T.DoubleType()),
        T.StructField("beta", T.DoubleType()), T.StructField("gamma", T.DoubleType()),
        T.StructField("sse", T.DoubleType()), T.StructField("resid_std", T.DoubleType()),
        T.StructField("level", T.DoubleType()), T.StructField("trend", T.DoubleType()),
        T.StructField("season", T.ArrayType(T.DoubleType())), T.StructField("steps", T.IntegerType()),
        T.StructField("n", T.IntegerType()), T.StructField("last_ds", T.DateType())])


def ets_fit_grouped(series: DataFrame, keys: list[str], forms, y: str, period: int, coarse, refine: bool,
                    form_column: str | None = None) -> DataFrame:
    forms, coarse = tuple(forms), tuple(coarse)
    wanted = [F.min(form_column).alias("_form")] if form_column else []
    points = F.sort_array(F.collect_list(F.struct(F.col("ds"), F.col(y).cast("double").alias("v"))))
    arrays = series.groupBy(*keys).agg(points.alias("_p"), *wanted).select(
        *keys, F.col("_p.v").alias("_y"), F.element_at("_p", -1)["ds"].cast("date").alias("last_ds"), F.size("_p").alias("n"),
        *(["_form"] if form_column else []))

    def fit(batches):
        for pdf in batches:
            for at in range(0, len(pdf), SERIES_AT_ONCE):
                yield _fit_batch(pdf.iloc[at:at + SERIES_AT_ONCE], keys, FORMS if form_column else forms, period, coarse, refine)

    return arrays.mapInPandas(fit, schema=fit_schema(series, keys))
