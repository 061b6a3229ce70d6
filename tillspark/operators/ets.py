"""Holt-Winters exponential smoothing for many series at once.

Forms: additive trend with additive seasonality (``add``), multiplicative seasonality
(``mul``), no seasonality (``none``, trend only) and simple smoothing (``simple``).

The candidate smoothing parameters are a fixed grid; the best candidate per series and
form has the lowest in-sample one-step SSE, and two finer grids (steps 0.1 and 0.02) are then
searched, each around the best candidate so far. Two engines give the same numbers:

* ``engine='sql'``: each series becomes one row with its ordered values (a calendar of
  months, bounded by the history length, not by the data), the grid is exploded per
  series row (a generator, not a join), and the recursion is a SQL ``aggregate`` fold
  over the value array with a struct state (level, trend, season array, step, SSE,
  error sum). Everything stays in the JVM, but higher-order functions are interpreted.
* ``engine='numpy'`` (default, ``ets_numpy.py``): all candidates of many series advance at
  once as arrays, in batches of series.

Initial states are the usual heuristics (first-cycle means), not fitted; the model
family and the selection protocol are those of the reference, the digits are not
those of a numerical optimiser.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark import schemas

FORMS = ("add", "mul", "none", "simple")
SEASONAL = ("add", "mul")
LABELS = {"add": "add", "mul": "mul", "none": "none (trend only)", "simple": "simple"}
COARSE = (0.1, 0.3, 0.5, 0.7, 0.9)
FINE_STEPS = (0.1, 0.02)


def series_arrays(series: DataFrame, keys: Sequence[str], y: str = "y") -> DataFrame:
    """One row per series: ordered values ``_y``, last month, length."""
    pts = F.sort_array(F.collect_list(F.struct(F.col("ds"), F.col(y).alias("v"))))
    g = series.groupBy(*keys).agg(pts.alias("_pts"))
    return g.select(*keys, F.transform("_pts", lambda p: p["v"]).alias("_y"),
                    F.element_at("_pts", -1)["ds"].alias("last_ds"), F.size("_pts").alias("n"))


def _mean(arr: Column, start: int, length: int) -> Column:
    part = F.slice(arr, start, length)
    return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / length


def _init(form: str, y: Column, m: int) -> tuple[Column, Column, Column, Column]:
    """Initial (level, trend, season array, values to fold)."""
    if form in SEASONAL:
        l0 = _mean(y, 1, m)
        b0 = (_mean(y, m + 1, m) - l0) / m
        first = F.slice(y, 1, m)
        s0 = F.transform(first, (lambda v: v - l0) if form == "add" else (lambda v: v / l0))
        return l0, b0, s0, y
    l0 = F.element_at(y, 1)
    b0 = (F.element_at(y, 2) - F.element_at(y, 1)) if form == "none" else F.lit(0.0)
    return l0, b0, F.array().cast("array<double>"), F.slice(y, 2, F.size(y) - 1)


def _fold(form: str, m: int, values: Column, l0: Column, b0: Column, s0: Column,
          alpha: Column, beta: Column, gamma: Column) -> Column:
    init = F.struct(l0.cast("double").alias("l"), b0.cast("double").alias("b"), s0.alias("s"),
                    F.lit(0).alias("t"), F.lit(0.0).alias("sse"), F.lit(0.0).alias("se"))

    def merge(st, x):
        lv, bv, s, t = st["l"], st["b"], st["s"], st["t"]
        if form in SEASONAL:
            sv = F.element_at(s, (t % m) + 1)
        if form == "add":
            yhat = lv + bv + sv
            l_new = alpha * (x - sv) + (1 - alpha) * (lv + bv)
        elif form == "mul":
            yhat = (lv + bv) * sv
            l_new = alpha * (x / sv) + (1 - alpha) * (lv + bv)
        elif form == "none":
            yhat = lv + bv
            l_new = alpha * x + (1 - alpha) * (lv + bv)
        else:
            yhat = lv
            l_new = alpha * x + (1 - alpha) * lv
        b_new = bv if form == "simple" else beta * (l_new - lv) + (1 - beta) * bv
        if form in SEASONAL:
            s_val = (gamma * (x - l_new) if form == "add" else gamma * (x / l_new)) + (1 - gamma) * sv
            s_new = F.transform(s, lambda v, j: F.when(j == t % m, s_val).otherwise(v))
        else:
            s_new = s
        e = x - yhat
        return F.struct(l_new.alias("l"), b_new.alias("b"), s_new.alias("s"), (t + 1).alias("t"),
                        (st["sse"] + e * e).alias("sse"), (st["se"] + e).alias("se"))

    return F.aggregate(values, init, merge)


def _grid(form: str, values: Sequence[float]) -> Column:
    """All (alpha, beta, gamma) candidates of a form, as an array literal."""
    betas = [0.0] if form == "simple" else values
    gammas = values if form in SEASONAL else [0.0]
    return F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.lit(float(b)).alias("beta"),
                              F.lit(float(g)).alias("gamma"))
                     for a in values for b in betas for g in gammas])


def _refine(form: str, best: Column, step: float) -> Column:
    """Candidates within one step of the best one so far."""
    d = [-step, 0.0, step]
    clip = lambda c: F.least(F.greatest(c, F.lit(0.01)), F.lit(0.99))
    betas = [0.0] if form == "simple" else d
    gammas = d if form in SEASONAL else [0.0]
    return F.array(*[F.struct(clip(best["alpha"] + da).alias("alpha"),
                              (F.lit(0.0) if form == "simple" else clip(best["beta"] + db)).alias("beta"),
                              (clip(best["gamma"] + dg) if form in SEASONAL else F.lit(0.0)).alias("gamma"))
                     for da in d for db in betas for dg in gammas])


def _search(arrays: DataFrame, keys: list[str], form: str, m: int, candidates: Column) -> DataFrame:
    l0, b0, s0, vals = _init(form, F.col("_y"), m)
    c = arrays.select(*keys, "_y", "last_ds", "n", F.explode(candidates).alias("p"))
    c = c.withColumn("_st", _fold(form, m, vals, l0, b0, s0, F.col("p.alpha"), F.col("p.beta"), F.col("p.gamma")))
    # lowest SSE; ties go to the smallest parameters (struct order)
    best = c.groupBy(*keys).agg(F.min(F.struct(F.col("_st.sse").alias("sse"), F.col("p").alias("p"),
                                               F.col("_st").alias("st"), "_y", "last_ds", "n")).alias("b"))
    return best.select(*keys, "b.*")


def ets_fit(series: DataFrame, keys: Sequence[str], forms: Sequence[str] = FORMS, y: str = "y",
            period: int = schemas.SEASON, coarse: Sequence[float] = COARSE, refine: bool = True,
            engine: str = "numpy", form_column: str | None = None) -> DataFrame:
    """Best smoothing parameters and final state per series and form.

    ``engine='numpy'`` (default) runs the search over batches of series with the candidates as
    arrays; ``engine='sql'`` runs it as ``aggregate``
    folds in the JVM. Both do the same floating-point operations in the same order
    and give the same numbers; the vector form is about two orders of magnitude faster
    because higher-order SQL functions are interpreted.

    Columns: keys, form, alpha, beta, gamma, sse, resid_std (population std of the
    one-step errors), level, trend, season, steps (points folded), n, last_ds. All forms need
    three points and seasonal ones two cycles: the cycle of a series of fewer than
    ``2 * period`` points is half its length, and below four points there is none (the SQL
    engine fits seasonal forms to full cycles only). A series that is too short gets no row. NaN/inf SSE (e.g. ``mul`` on a series with zeros) never wins. ``form_column``
    names a column of ``series`` with the one form to fit to each series.
    """
    keys = list(keys)
    if form_column and engine != "numpy":
        raise ValueError("form_column needs the numpy engine")
    if engine == "numpy":
        from tillspark.operators.ets_numpy import ets_fit_grouped
        return ets_fit_grouped(series, keys, forms, y, period, coarse, refine, form_column)
    arrays = series_arrays(series, keys, y)
    out = None
    for form in forms:
        need = 2 * period if form in SEASONAL else 3
        a = arrays.filter(F.col("n") >= need)
        best = _search(a, keys, form, period, _grid(form, coarse))
        for step in FINE_STEPS if refine else ():
            best = _search(best.select(*keys, "_y", "last_ds", "n", F.col("p").alias("_best")), keys, form,
                           period, _refine(form, F.col("_best"), step))
        part = best.select(
            *keys, F.lit(form).alias("form"), F.col("p.alpha").alias("alpha"), F.col("p.beta").alias("beta"),
            F.col("p.gamma").alias("gamma"), "sse",
            F.sqrt(F.greatest(F.col("st.sse") / F.col("st.t") - F.pow(F.col("st.se") / F.col("st.t"), 2),
                              F.lit(0.0))).alias("resid_std"),
            F.col("st.l").alias("level"), F.col("st.b").alias("trend"), F.col("st.s").alias("season"),
            F.col("st.t").alias("steps"), "n", "last_ds")
        part = part.filter(~F.isnan("sse") & (F.col("sse") < F.lit(float("inf"))))
        out = part if out is None else out.unionByName(part)
    return out


def ets_forecast(fits: DataFrame, keys: Sequence[str], h: int | str = schemas.HORIZON,
                 period: int = schemas.SEASON, z: float = schemas.Z80) -> DataFrame:
    """h-step forecasts from fitted states with a constant +-z*sigma interval.

    ``h`` is a number of months or the name of a per-series column. Season slot of
    step k is (steps + k - 1) mod the length of the season, the slot the recursion would use next.
    """
    keys = list(keys)
    hc = F.col(h) if isinstance(h, str) else F.lit(h)
    f = fits.filter(hc >= 1).select("*", F.explode(F.sequence(F.lit(1), hc.cast("int"))).alias("step"))
    k = F.col("step")
    base = F.col("level") + k * F.col("trend")
    cycle = F.when(F.size("season") > 0, F.size("season")).otherwise(F.lit(period))
    sv = F.try_element_at(F.col("season"), (((F.col("steps") + k - 1) % cycle) + 1).cast("int"))
    yhat = (F.when(F.col("form") == "add", base + sv)
            .when(F.col("form") == "mul", base * sv)
            .when(F.col("form") == "none", base)
            .otherwise(F.col("level")))
    return f.select(*keys, "form", "step", F.add_months("last_ds", k).alias("ds"), yhat.alias("forecast"),
                    (yhat - z * F.col("resid_std")).alias("lower"), (yhat + z * F.col("resid_std")).alias("upper"))
