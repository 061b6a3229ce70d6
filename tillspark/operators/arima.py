"""Seasonal ARIMA per series (I7, I8, I12), fitted in grouped pandas functions.

The estimation is conditional sum of squares (CSS): difference the series (d regular,
D seasonal), run the multiplicative ARMA residual recursion from zero pre-sample
values, minimise the sum of
squares with Levenberg-Marquardt steps (numeric Jacobian). AIC =
n*ln(SSE/n) + 2*(k+1). Forecasts run the recursion forward with zero future shocks
and undo the differencing; the 80 % interval uses the psi weights of the full
(integrated) model. This is the model of the reference, not statsmodels' exact
state-space likelihood, so coefficients agree in kind, not in digits.

Spark's part: one group per series (fixed order), or one group per series and
candidate order (order search): the candidates are generated per series row with
``explode`` and fitted in parallel; the best order per series is a ``min_by`` on AIC.
A series is a calendar of months, so every group is small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


Z80 = 1.2815515655446004  # standard normal quantile at 0.9 (two-sided 80 %)


@dataclass(frozen=True)
class Order:
    p: int = 1
    d: int = 1
    q: int = 1
    P: int = 1
    D: int = 1
    Q: int = 1
    m: int = 12


def difference(y: np.ndarray, d: int, D: int, m: int) -> np.ndarray:
    w = np.asarray(y, dtype=np.float64)
    for _ in range(D):
        w = w[m:] - w[:-m]
    for _ in range(d):
        w = w[1:] - w[:-1]
    return w


def _poly_ar(phi: np.ndarray, Phi: np.ndarray, m: int) -> np.ndarray:
    """Coefficients c of (1 - sum phi B^i)(1 - sum Phi B^(m j)) = 1 - sum c_k B^k."""
    a = np.zeros(len(phi) + 1)
    a[0] = 1.0
    a[1:] = -phi
    s = np.zeros(m * len(Phi) + 1)
    s[0] = 1.0
    for j, v in enumerate(Phi, start=1):
        s[m * j] = -v
    return -np.convolve(a, s)[1:]


def _poly_ma(theta: np.ndarray, Theta: np.ndarray, m: int) -> np.ndarray:
    """Coefficients c of (1 + sum theta B^i)(1 + sum Theta B^(m j)) = 1 + sum c_k B^k."""
    a = np.concatenate([[1.0], theta])
    s = np.zeros(m * len(Theta) + 1)
    s[0] = 1.0
    for j, v in enumerate(Theta, start=1):
        s[m * j] = v
    return np.convolve(a, s)[1:]


def _split(params: np.ndarray, o: Order):
    i = 0
    phi = params[i:i + o.p]; i += o.p
    theta = params[i:i + o.q]; i += o.q
    Phi = params[i:i + o.P]; i += o.P
    Theta = params[i:i + o.Q]
    return phi, theta, Phi, Theta


def css_residuals(w: np.ndarray, params: np.ndarray, o: Order) -> np.ndarray:
    """Residuals of the ARMA part on the differenced series, pre-sample values and
    shocks taken as zero (so every differenced point yields a residual)."""
    phi, theta, Phi, Theta = _split(params, o)
    # The expanded seasonal polynomials are mostly zeros: loop over the non-zero lags
    # only, in plain floats (small numpy calls cost more than they save here).
    nz_ar = [(i, float(c)) for i, c in enumerate(_poly_ar(phi, Phi, o.m), start=1) if c != 0.0]
    nz_ma = [(j, float(c)) for j, c in enumerate(_poly_ma(theta, Theta, o.m), start=1) if c != 0.0]
    wl = [float(v) for v in w]
    e = [0.0] * len(wl)
    for t in range(len(wl)):
        v = wl[t]
        for lag, c in nz_ar:
            if lag <= t:
                v -= c * wl[t - lag]
        for lag, c in nz_ma:
            if lag <= t:
                v -= c * e[t - lag]
        e[t] = v
    return np.array(e)


def fit_css(y: np.ndarray, o: Order, max_iter: int = 50):
    """Fit by Levenberg-Marquardt on the CSS. Returns (params, sse, n_eff, status)."""
    w = difference(y, o.d, o.D, o.m)
    k = o.p + o.q + o.P + o.Q
    n_eff = len(w)
    if n_eff <= k + 1:
        return np.zeros(k), float("nan"), max(n_eff, 0), "too short"
    params = np.zeros(k)
    if k == 0:
        e = css_residuals(w, params, o)
        return params, float(e @ e), n_eff, "ok"
    e = css_residuals(w, params, o)
    sse = float(e @ e)
    mu = 1e-3
    for _ in range(max_iter):
        jac = np.empty((len(e), k))
        for j in range(k):
            step = 1e-6 * max(1.0, abs(params[j]))
            p2 = params.copy()
            p2[j] += step
            jac[:, j] = (css_residuals(w, p2, o) - e) / step
        jtj, jte = jac.T @ jac, jac.T @ e
        improved = False
        for _ in range(12):  # Levenberg-Marquardt: damp until the step lowers the SSE
            a = jtj + mu * np.diag(np.diag(jtj) + 1e-12)
            try:
                delta = np.linalg.solve(a, -jte)
            except np.linalg.LinAlgError:
                mu *= 10
                continue
            cand = np.clip(params + delta, -0.999, 0.999)
            e2 = css_residuals(w, cand, o)
            s2 = float(e2 @ e2)
            if np.isfinite(s2) and s2 < sse:
                rel = (sse - s2) / max(sse, 1e-300)
                params, e, sse, improved = cand, e2, s2, True
                mu = max(mu / 10, 1e-9)
                break
            mu *= 10
        if not improved or rel < 1e-10:
            break
    return params, sse, n_eff, "ok"


def aic(sse: float, n_eff: int, k: int) -> float:
    if not np.isfinite(sse) or n_eff <= 0 or sse <= 0:
        return float("inf")
    return n_eff * np.log(sse / n_eff) + 2 * (k + 1)


def forecast(y: np.ndarray, params: np.ndarray, o: Order, h: int, sigma2: float):
    """h-step forecasts on the original scale and their standard errors."""
    y = np.asarray(y, dtype=np.float64)
    phi, theta, Phi, Theta = _split(params, o)
    ar = _poly_ar(phi, Phi, o.m)
    ma = _poly_ma(theta, Theta, o.m)
    # Full AR polynomial including the differencing: phi*(B) = ar(B) (1-B)^d (1-B^m)^D
    full = np.concatenate([[1.0], -ar])
    for _ in range(o.d):
        full = np.convolve(full, [1.0, -1.0])
    for _ in range(o.D):
        seas = np.zeros(o.m + 1)
        seas[0], seas[o.m] = 1.0, -1.0
        full = np.convolve(full, seas)
    full_ar = -full[1:]
    w = difference(y, o.d, o.D, o.m)
    e_in = css_residuals(w, params, o)
    e = np.concatenate([np.zeros(len(y) - len(e_in)), e_in])
    hist = list(y)
    errs = list(e)
    out = []
    for _ in range(h):
        t = len(hist)
        v = 0.0
        for i, c in enumerate(full_ar, start=1):
            if t - i >= 0:
                v += c * hist[t - i]
        for j, c in enumerate(ma, start=1):
            if t - j >= 0 and t - j < len(errs):
                v += c * errs[t - j]
        hist.append(v)
        errs.append(0.0)
        out.append(v)
    # psi weights of the integrated model
    psi = np.zeros(h)
    psi[0] = 1.0
    for j in range(1, h):
        acc = ma[j - 1] if j - 1 < len(ma) else 0.0
        for i in range(1, j + 1):
            if i - 1 < len(full_ar):
                acc += full_ar[i - 1] * psi[j - i]
        psi[j] = acc
    se = np.sqrt(sigma2 * np.cumsum(psi ** 2))
    return np.array(out), se


# --------------------------------------------------------------------------- Spark plans

def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def sarima_forecast(series: DataFrame, keys: Sequence[str], order: Order = Order(), h: int | str = 6,
                    y: str = "y") -> DataFrame:
    """Fit one SARIMA order per series and forecast ``h`` months.

    ``h`` is a number of months or the name of a per-series column. One row per series
    and step: ds, forecast, lower/upper 80 %, aic, sigma, status. Series too short for
    the order yield a single row with status 'too short'.
    """
    keys = list(keys)
    hc = F.col(h) if isinstance(h, str) else F.lit(h)
    data = series.select(*keys, "ds", F.col(y).cast("double").alias("_y"), hc.cast("int").alias("_h"))
    schema = T.StructType(_key_fields(series, keys) + [
        T.StructField("step", T.IntegerType()), T.StructField("ds", T.DateType()),
        T.StructField("forecast", T.DoubleType()), T.StructField("lower", T.DoubleType()),
        T.StructField("upper", T.DoubleType()), T.StructField("aic", T.DoubleType()),
        T.StructField("sigma", T.DoubleType()), T.StructField("status", T.StringType())])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        kv = {k: pdf[k].iloc[0] for k in keys}
        yv = pdf["_y"].to_numpy()
        params, sse, n_eff, status = fit_css(yv, order)
        if status != "ok":
            return pd.DataFrame([{**kv, "step": None, "ds": None, "forecast": None, "lower": None, "upper": None,
                                  "aic": None, "sigma": None, "status": status}], columns=schema.fieldNames())
        sigma2 = sse / n_eff
        h = int(pdf["_h"].iloc[0])
        fc, se = forecast(yv, params, order, h, sigma2)
        last = pd.Timestamp(pdf["ds"].iloc[-1])
        rows = [{**kv, "step": i + 1, "ds": (last + pd.DateOffset(months=i + 1)).date(), "forecast": fc[i],
                 "lower": fc[i] - Z80 * se[i], "upper": fc[i] + Z80 * se[i],
                 "aic": aic(sse, n_eff, len(params)), "sigma": float(np.sqrt(sigma2)), "status": "ok"}
                for i in range(h)]
        return pd.DataFrame(rows, columns=schema.fieldNames())

    return data.groupBy(*keys).applyInPandas(fn, schema=schema)


def kpss_ndiffs(w: np.ndarray, max_d: int = 2, crit: float = 0.463) -> int:
    """Number of regular differences by the KPSS level test at 5 % (critical value 0.463)."""
    x = np.asarray(w, dtype=np.float64)
    for d in range(max_d + 1):
        n = len(x)
        if n < 4:
            return d
        e = x - x.mean()
        s = np.cumsum(e)
        lags = int(np.trunc(np.sqrt(n)))  # Newey-West window, the 'legacy' choice
        lr = e @ e / n
        for k in range(1, lags + 1):
            lr += 2 * (1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / n
        stat = (s @ s) / (n * n * lr) if lr > 0 else 0.0
        if stat <= crit or d == max_d:
            return d
        x = x[1:] - x[:-1]
    return max_d


def stepwise_search(yv: np.ndarray, max_p: int, max_q: int, max_P: int, max_Q: int, D: int, m: int,
                    max_fits: int = 100):
    """Stepwise AIC search (the auto-ARIMA procedure): start from the standard orders,
    move to the best neighbour (each of p, q, P, Q by +-1, and p, q or P, Q together)
    while the AIC improves. Returns (best order tuple, aic, fits evaluated)."""
    d = kpss_ndiffs(difference(yv, 0, D, m))
    seen: dict[tuple, float] = {}

    def score(c):
        if c not in seen:
            p, q, P, Q = c
            params, sse, n_eff, status = fit_css(yv, Order(p, d, q, P, D, Q, m))
            seen[c] = aic(sse, n_eff, len(params)) if status == "ok" else float("inf")
        return seen[c]

    def ok(c):
        p, q, P, Q = c
        return 0 <= p <= max_p and 0 <= q <= max_q and 0 <= P <= max_P and 0 <= Q <= max_Q

    start = [c for c in [(2, 2, 1, 1), (0, 0, 0, 0), (1, 0, 1, 0), (0, 1, 0, 1)]
             if ok((min(c[0], max_p), min(c[1], max_q), min(c[2], max_P), min(c[3], max_Q)))]
    start = [(min(c[0], max_p), min(c[1], max_q), min(c[2], max_P), min(c[3], max_Q)) for c in start]
    best = min(start, key=lambda c: (score(c), c))
    moves = [(dp, dq, dP, dQ) for dp, dq, dP, dQ in
             [(0, 0, 1, 0), (0, 0, -1, 0), (0, 0, 0, 1), (0, 0, 0, -1), (0, 0, 1, 1), (0, 0, -1, -1),
              (1, 0, 0, 0), (-1, 0, 0, 0), (0, 1, 0, 0), (0, -1, 0, 0), (1, 1, 0, 0), (-1, -1, 0, 0)]]
    improved = True
    while improved and len(seen) < max_fits:
        improved = False
        for mv in moves:
            c = tuple(a + b for a, b in zip(best, mv))
            if ok(c) and c not in seen and len(seen) < max_fits and score(c) < score(best):
                best, improved = c, True
                break
    return (best[0], d, best[1], best[2], D, best[3]), score(best), len(seen)


def sarima_order_search(series: DataFrame, keys: Sequence[str], max_p: int = 3, max_q: int = 3,
                        max_P: int = 2, max_Q: int = 2, D: int = 1, m: int = 12, y: str = "y",
                        stepwise: bool = True) -> DataFrame:
    """Lowest-AIC order per series within p, q <= 3 and P, Q <= 2, D = 1 (I8).

    d comes first from a KPSS test on the seasonally differenced series (AIC does not
    compare models with different d). ``stepwise=True`` (the reference's setting) walks
    from the standard starting orders to better neighbours, one group per series.
    ``stepwise=False`` fits every order: each candidate is its own group, so the fits
    run in parallel, and the winner per series is the minimum of (aic, order). Output
    columns p, d, q, sp, sd, sq, m (seasonal P, D, Q as sp, sd, sq), aic, candidates.
    """
    keys = list(keys)
    if stepwise:
        data = series.select(*keys, "ds", F.col(y).cast("double").alias("_y"))
        out_schema = T.StructType(_key_fields(series, keys) + [
            T.StructField(c, T.IntegerType()) for c in ("p", "d", "q", "sp", "sd", "sq", "m")] + [
            T.StructField("aic", T.DoubleType()), T.StructField("candidates", T.LongType())])

        def walk(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("ds")
            kv = {k: pdf[k].iloc[0] for k in keys}
            (p, d, q, P, D_, Q), best_aic, n = stepwise_search(pdf["_y"].to_numpy(), max_p, max_q, max_P, max_Q, D, m)
            if not np.isfinite(best_aic):
                return pd.DataFrame([], columns=out_schema.fieldNames())
            return pd.DataFrame([{**kv, "p": p, "d": d, "q": q, "sp": P, "sd": D_, "sq": Q, "m": m, "aic": best_aic,
                                  "candidates": n}], columns=out_schema.fieldNames())

        return data.groupBy(*keys).applyInPandas(walk, schema=out_schema)
    grid = [(p, q, P, Q) for p, q, P, Q in product(range(max_p + 1), range(max_q + 1), range(max_P + 1),
                                                   range(max_Q + 1))]
    # Spark resolves names case-insensitively: the seasonal orders are sp, sd, sq.
    cands = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.lit(P).alias("sp"), F.lit(Q).alias("sq"))
                      for p, q, P, Q in grid])
    data = series.select(*keys, "ds", F.col(y).cast("double").alias("_y"), F.explode(cands).alias("_o")) \
        .select(*keys, "ds", "_y", F.col("_o.p").alias("p"), F.col("_o.q").alias("q"),
                F.col("_o.sp").alias("sp"), F.col("_o.sq").alias("sq"))
    schema = T.StructType(_key_fields(series, keys) + [
        T.StructField("p", T.IntegerType()), T.StructField("d", T.IntegerType()), T.StructField("q", T.IntegerType()),
        T.StructField("sp", T.IntegerType()), T.StructField("sd", T.IntegerType()), T.StructField("sq", T.IntegerType()),
        T.StructField("m", T.IntegerType()), T.StructField("aic", T.DoubleType()),
        T.StructField("sse", T.DoubleType()), T.StructField("status", T.StringType())])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        kv = {k: pdf[k].iloc[0] for k in keys}
        p, q, P, Q = (int(pdf[c].iloc[0]) for c in ("p", "q", "sp", "sq"))
        yv = pdf["_y"].to_numpy()
        d = kpss_ndiffs(difference(yv, 0, D, m))
        o = Order(p, d, q, P, D, Q, m)
        params, sse, n_eff, status = fit_css(yv, o)
        return pd.DataFrame([{**kv, "p": p, "d": d, "q": q, "sp": P, "sd": D, "sq": Q, "m": m,
                              "aic": aic(sse, n_eff, len(params)), "sse": sse, "status": status}],
                            columns=schema.fieldNames())

    fits = data.groupBy(*keys, "p", "q", "sp", "sq").applyInPandas(fn, schema=schema)
    ok = fits.filter((F.col("status") == "ok") & (F.col("aic") < F.lit(float("inf"))))
    best = ok.groupBy(*keys).agg(F.min(F.struct("aic", "p", "d", "q", "sp", "sd", "sq", "m")).alias("b"),
                                 F.count(F.lit(1)).alias("candidates"))
    return best.select(*keys, "b.p", "b.d", "b.q", "b.sp", "b.sd", "b.sq", "b.m", "b.aic", "candidates")
