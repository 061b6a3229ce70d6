"""Per-series diagnostics in grouped pandas functions: PACF (I5) and the ADF test.

Both need small dense linear algebra on one series (Durbin-Levinson, least squares),
so each series is one group; groups are month calendars, never data-sized.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------------------
# MacKinnon (1994) response-surface coefficients for the ADF p-value and
# MacKinnon (2010) finite-sample critical values, regression with a constant, one
# variable.
# ---------------------------------------------------------------------------
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRIT = {"1%": (-3.43035, -6.5393, -16.786, -79.433),
            "5%": (-2.86154, -2.8903, -4.234, -40.040),
            "10%": (-2.56677, -1.5384, -2.809, 0.0)}


def _norm_cdf(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def adf_pvalue(stat: float) -> float:
    if stat > ADF_TAU_MAX:
        return 1.0
    if stat < ADF_TAU_MIN:
        return 0.0
    coefs = ADF_SMALL_P if stat <= ADF_TAU_STAR else ADF_LARGE_P
    return _norm_cdf(sum(c * stat ** i for i, c in enumerate(coefs)))


def adf_crit(nobs: int) -> dict[str, float]:
    return {k: b[0] + b[1] / nobs + b[2] / nobs ** 2 + b[3] / nobs ** 3 for k, b in ADF_CRIT.items()}


def _ols(X: np.ndarray, yv: np.ndarray):
    beta, *_ = np.linalg.lstsq(X, yv, rcond=None)
    resid = yv - X @ beta
    n, k = X.shape
    sse = float(resid @ resid)
    sigma2 = sse / (n - k)
    cov = sigma2 * np.linalg.pinv(X.T @ X)
    return beta, np.sqrt(np.diag(cov)), sse


def adf(y: np.ndarray, maxlag: int | None = None):
    """ADF with a constant; lag chosen by AIC over 0..maxlag on a common sample."""
    y = np.asarray(y, dtype=np.float64)
    n = len(y)
    if maxlag is None:
        maxlag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
        maxlag = min(n // 2 - 2, maxlag)
    maxlag = max(maxlag, 0)
    dy = np.diff(y)
    if len(dy) - maxlag < 4:
        return None

    def design(lag: int, start: int):
        rows = np.arange(start, len(dy))
        X = [np.ones(len(rows)), y[rows]]
        for i in range(1, lag + 1):
            X.append(dy[rows - i])
        return np.column_stack(X), dy[rows]

    best = None
    for lag in range(maxlag + 1):
        X, target = design(lag, maxlag)
        _, _, sse = _ols(X, target)
        nobs = len(target)
        crit = nobs * math.log(sse / nobs) + 2 * X.shape[1] if sse > 0 else -math.inf
        if best is None or crit < best[0]:
            best = (crit, lag)
    lag = best[1]
    X, target = design(lag, lag)
    beta, se, _ = _ols(X, target)
    stat = float(beta[1] / se[1]) if se[1] > 0 else float("nan")
    return stat, adf_pvalue(stat), lag, len(target)


def pacf_yw(y: np.ndarray, nlags: int) -> np.ndarray:
    """PACF by Yule-Walker with biased autocovariances (Durbin-Levinson)."""
    x = np.asarray(y, dtype=np.float64) - np.mean(y)
    n = len(x)
    nlags = min(nlags, n - 1)
    acov = np.array([x[: n - k] @ x[k:] / n for k in range(nlags + 1)])
    out = np.zeros(nlags + 1)
    out[0] = 1.0
    if acov[0] == 0:
        return out
    phi_prev = np.zeros(0)
    v = acov[0]
    for k in range(1, nlags + 1):
        num = acov[k] - (phi_prev @ acov[1:k][::-1] if k > 1 else 0.0)
        a = num / v
        phi = np.concatenate([phi_prev - a * phi_prev[::-1], [a]])
        v = v * (1 - a * a)
        out[k] = a
        phi_prev = phi
    return out


def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def pacf(series: DataFrame, keys: Sequence[str], lags: int = 12, y: str = "y") -> DataFrame:
    """Partial autocorrelation for lags 0..``lags`` per series."""
    keys = list(keys)
    data = series.select(*keys, "ds", F.col(y).cast("double").alias("_y"))
    schema = T.StructType(_key_fields(series, keys) + [T.StructField("lag", T.IntegerType()),
                                                       T.StructField("pacf", T.DoubleType())])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        kv = {k: pdf[k].iloc[0] for k in keys}
        vals = pacf_yw(pdf["_y"].to_numpy(), lags)
        return pd.DataFrame([{**kv, "lag": i, "pacf": float(v)} for i, v in enumerate(vals)],
                            columns=schema.fieldNames())

    return data.groupBy(*keys).applyInPandas(fn, schema=schema)


def adf_test(series: DataFrame, keys: Sequence[str], y: str = "y", alpha: float = 0.05) -> DataFrame:
    """ADF test of each series and of its first difference.

    Columns: keys, variant ('original'/'first_difference'), statistic, p_value, used_lag,
    nobs, crit_1pct, crit_5pct, crit_10pct, stationary (p < alpha).
    """
    keys = list(keys)
    data = series.select(*keys, "ds", F.col(y).cast("double").alias("_y"))
    schema = T.StructType(_key_fields(series, keys) + [
        T.StructField("variant", T.StringType()), T.StructField("statistic", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()), T.StructField("used_lag", T.IntegerType()),
        T.StructField("nobs", T.IntegerType()), T.StructField("crit_1pct", T.DoubleType()),
        T.StructField("crit_5pct", T.DoubleType()), T.StructField("crit_10pct", T.DoubleType()),
        T.StructField("stationary", T.BooleanType())])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        kv = {k: pdf[k].iloc[0] for k in keys}
        yv = pdf["_y"].to_numpy()
        rows = []
        for variant, vals in (("original", yv), ("first_difference", np.diff(yv))):
            res = adf(vals)
            if res is None:
                rows.append({**kv, "variant": variant, "statistic": None, "p_value": None, "used_lag": None,
                             "nobs": None, "crit_1pct": None, "crit_5pct": None, "crit_10pct": None,
                             "stationary": None})
                continue
            stat, p, lag, nobs = res
            crit = adf_crit(nobs)
            rows.append({**kv, "variant": variant, "statistic": stat, "p_value": p, "used_lag": lag, "nobs": nobs,
                         "crit_1pct": crit["1%"], "crit_5pct": crit["5%"], "crit_10pct": crit["10%"],
                         "stationary": bool(p < alpha)})
        return pd.DataFrame(rows, columns=schema.fieldNames())

    return data.groupBy(*keys).applyInPandas(fn, schema=schema)
