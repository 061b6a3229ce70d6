"""Per-series time-series operators on long-form data ``(keys..., ds, y)``.

Every operator works on any number of series at once: windows are partitioned by the
series keys, so the work spreads over series, and one series is a calendar of months
(hundreds of rows at most), never a data-sized group.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.functions.dates import month_start


def _keys(keys: Sequence[str] | str | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _w(keys: list[str]) -> Window:
    return Window.partitionBy(*keys) if keys else Window.partitionBy()


def monthly_series(lines: DataFrame, keys: Sequence[str] | str | None = None, ts: str = "InvoiceDate",
                   value: str = "TotalRevenue", fill_gaps: bool = True) -> DataFrame:
    """Monthly sum of ``value`` per series, months as first-of-month dates.

    With ``fill_gaps`` every month between a series' first and last month is present
    (0 where nothing was sold), so lags and seasons line up by position.
    """
    ks = _keys(keys)
    m = lines.groupBy(*ks, month_start(ts).alias("ds")).agg(F.sum(value).alias("_y"))
    if fill_gaps:
        bounds = m.groupBy(*ks).agg(F.min("ds").alias("_lo"), F.max("ds").alias("_hi"))
        cal = bounds.select(*ks, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("ds"))
        m = cal.join(m, [*ks, "ds"], "left").withColumn("_y", F.coalesce("_y", F.lit(0)))
    return m.select(*ks, "ds", F.col("_y").cast("double").alias("y"))


def first_difference(series: DataFrame, keys: Sequence[str] | str | None = None, y: str = "y",
                     out: str = "diff", lag: int = 1) -> DataFrame:
    """``y - lag(y)`` within each series; NULL for the first ``lag`` rows."""
    ks = _keys(keys)
    w = _w(ks).orderBy("ds")
    return series.withColumn(out, F.col(y) - F.lag(y, lag).over(w))


def train_test_split(series: DataFrame, keys: Sequence[str] | str | None = None,
                     ratio: float = 0.8) -> DataFrame:
    """Chronological split: the first ``floor(n * ratio)`` rows of a series train."""
    ks = _keys(keys)
    w = _w(ks).orderBy("ds")
    n = F.count(F.lit(1)).over(_w(ks))
    cut = F.floor(n * F.lit(Decimal(str(ratio))))
    return series.withColumn("split", F.when(F.row_number().over(w) <= cut, "train").otherwise("test"))


def seasonal_decompose(series: DataFrame, keys: Sequence[str] | str | None = None, y: str = "y",
                       period: int = 12) -> DataFrame:
    """Additive decomposition with a centred moving-average trend.

    trend: centred moving average (2 x period for an even period); its missing ends are
    extrapolated by a least-squares line through the nearest ``period`` trend values
    (``regr_slope``/``regr_intercept`` windows). seasonal: mean detrended value of each
    position in the cycle, centred to mean zero. resid = y - trend - seasonal. Series
    shorter than two cycles get NULL components.
    """
    ks = _keys(keys)
    w = _w(ks).orderBy("ds")
    wall = _w(ks)
    h = period // 2
    s = (series.withColumn("_i", F.row_number().over(w) - 1)
         .withColumn("_n", F.count(F.lit(1)).over(wall)))
    i, n = F.col("_i"), F.col("_n")
    # The window is added up from its first to its last value, one division at the end: the
    # trend does not depend on how an engine keeps a running sum.
    yd = F.col(y).cast("double")
    at = lambda k: yd if k == 0 else F.lag(yd, -k).over(w) if k < 0 else F.lead(yd, k).over(w)
    inner = range(-h + 1, h) if period % 2 == 0 else range(-h, h + 1)
    total = reduce(add, [at(k) for k in inner])
    ma = ((at(-h) + at(h)) / 2 + total) / period if period % 2 == 0 else total / period
    s = s.withColumn("_ma", F.when((i >= h) & (i <= n - 1 - h), ma))
    front = (i >= h) & (i <= h + period - 1)
    back = (i >= n - h - period) & (i <= n - 1 - h)

    def fit(mask: Column, fn) -> Column:
        return fn(F.when(mask, F.col("_ma")), F.when(mask, i.cast("double"))).over(wall)

    s = s.select("*", fit(front, F.regr_slope).alias("_fs"), fit(front, F.regr_intercept).alias("_fi"),
                 fit(back, F.regr_slope).alias("_bs"), fit(back, F.regr_intercept).alias("_bi"))
    trend = (F.when(i < h, F.col("_fi") + F.col("_fs") * i)
             .when(i > n - 1 - h, F.col("_bi") + F.col("_bs") * i)
             .otherwise(F.col("_ma")))
    s = s.withColumn("trend", F.when(n >= 2 * period, trend))
    s = s.withColumn("_phase", i % period).withColumn("_d", F.col(y) - F.col("trend"))
    wp = Window.partitionBy(*ks, "_phase")
    s = s.withColumn("_pm", F.avg("_d").over(wp)).withColumn("_pc", F.count(F.lit(1)).over(wp))
    centre = F.sum(F.col("_pm") / F.col("_pc")).over(wall) / period
    s = s.withColumn("seasonal", F.col("_pm") - centre)
    return s.select(*ks, "ds", F.col(y).alias("observed"), "trend", "seasonal",
                    (F.col(y) - F.col("trend") - F.col("seasonal")).alias("resid"))


def seasonal_index(decomposed: DataFrame, keys: Sequence[str] | str | None = None) -> DataFrame:
    """Mean seasonal effect per calendar month."""
    ks = _keys(keys)
    return decomposed.groupBy(*ks, F.month("ds").alias("month")).agg(F.avg("seasonal").alias("seasonal_effect"))


def acf(series: DataFrame, keys: Sequence[str] | str | None = None, y: str = "y", lags: int = 12) -> DataFrame:
    """Autocorrelation for lags 0..``lags`` per series (I4).

    acf(k) = sum_t (y_t - mean)(y_{t+k} - mean) / sum_t (y_t - mean)^2, the biased
    estimator of the usual ACF plot. Lags are ``lead`` windows; one aggregate per series.
    """
    ks = _keys(keys)
    w = _w(ks).orderBy("ds")
    dev = F.col(y) - F.avg(y).over(_w(ks))
    s = series.withColumn("_dev", dev)
    s = s.select(*ks, "_dev", *[F.lead("_dev", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = s.groupBy(*ks).agg(F.sum(F.col("_dev") * F.col("_dev")).alias("_c0"),
                              *[F.sum(F.col("_dev") * F.col(f"_l{k}")).alias(f"_c{k}") for k in range(1, lags + 1)])
    pairs = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_c{k}").alias("c")) for k in range(0, lags + 1)])
    return sums.select(*ks, "_c0", F.explode(pairs).alias("_p")).select(
        *ks, F.col("_p.lag").alias("lag"), F.try_divide(F.col("_p.c"), F.col("_c0")).alias("acf"))


def forecast_metrics(df: DataFrame, keys: Sequence[str] | str | None = None, actual: str = "actual",
                     predicted: str = "predicted") -> DataFrame:
    """MAPE (zero actuals left out), MAE, RMSE and accuracy = 100 - MAPE per group."""
    ks = _keys(keys)
    a, p = F.col(actual), F.col(predicted)
    ape = F.when(a != 0, F.abs((a - p) / a))
    agg = df.groupBy(*ks).agg((F.avg(ape) * 100).alias("mape"), F.avg(F.abs(a - p)).alias("mae"),
                              F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"), F.count(F.lit(1)).alias("n"))
    return agg.withColumn("accuracy", 100 - F.col("mape"))


def future_calendar(series: DataFrame, keys: Sequence[str] | str | None = None, h: int = 6) -> DataFrame:
    """The ``h`` month starts after each series' last month."""
    ks = _keys(keys)
    last = series.groupBy(*ks).agg(F.max("ds").alias("_last"))
    steps = F.sequence(F.lit(1), F.lit(h))
    return last.select(*ks, "_last", F.explode(steps).alias("step")).select(
        *ks, "step", F.add_months("_last", F.col("step")).alias("ds"))
