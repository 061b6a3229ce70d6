"""DuckDB oracle of the Holt-Winters grid search: a recursive CTE replays the recursion.

Same grid (coarse, then steps of 0.1 and 0.02 around the best), same initial states, same
order of floating-point operations, so the numbers are bit-identical when both engines
follow IEEE arithmetic.
"""

from __future__ import annotations

COARSE = "[0.1, 0.3, 0.5, 0.7, 0.9]::DOUBLE[]"
DELTAS = "[-0.1, 0.0, 0.1]::DOUBLE[]"
FINER = "[-0.02, 0.0, 0.02]::DOUBLE[]"

_FORM_NEED = "CASE WHEN f.form IN ('add', 'mul') THEN 24 ELSE 3 END"


def _init(arrays: str, cands: str) -> str:
    """Initial state rows for candidates ``cands`` (Country, form, alpha, beta, gamma)."""
    return f"""
    SELECT c.Country, c.form, c.alpha, c.beta, c.gamma, a.n, a.last_ds,
           CASE WHEN c.form IN ('add', 'mul') THEN a.ys ELSE a.ys[2:] END AS vals,
           0 AS t,
           CASE WHEN c.form IN ('add', 'mul') THEN list_reduce(a.ys[1:12], lambda acc, x: acc + x) / 12
                ELSE a.ys[1] END AS l,
           CASE WHEN c.form IN ('add', 'mul')
                  THEN (list_reduce(a.ys[13:24], lambda acc, x: acc + x) / 12
                        - list_reduce(a.ys[1:12], lambda acc, x: acc + x) / 12) / 12
                WHEN c.form = 'none' THEN a.ys[2] - a.ys[1]
                ELSE CAST(0.0 AS DOUBLE) END AS b,
           CASE WHEN c.form = 'add'
                  THEN list_transform(a.ys[1:12], lambda v: v - list_reduce(a.ys[1:12], lambda acc, x: acc + x) / 12)
                WHEN c.form = 'mul'
                  THEN list_transform(a.ys[1:12], lambda v: v / (list_reduce(a.ys[1:12], lambda acc, x: acc + x) / 12))
                ELSE CAST([] AS DOUBLE[]) END AS s,
           CAST(0.0 AS DOUBLE) AS sse, CAST(0.0 AS DOUBLE) AS se
    FROM {cands} c JOIN {arrays} a USING (Country)"""


_STEP = """
    SELECT Country, form, alpha, beta, gamma, n, last_ds, vals, t + 1 AS t,
           l_new AS l,
           CASE WHEN form = 'simple' THEN b ELSE beta * (l_new - l) + (1 - beta) * b END AS b,
           CASE WHEN form = 'add'
                  THEN list_transform(s, lambda v, j: CASE WHEN j = (t % 12) + 1
                                                      THEN gamma * (x - l_new) + (1 - gamma) * sv ELSE v END)
                WHEN form = 'mul'
                  THEN list_transform(s, lambda v, j: CASE WHEN j = (t % 12) + 1
                                                      THEN gamma * (x / l_new) + (1 - gamma) * sv ELSE v END)
                ELSE s END AS s,
           sse + (x - yhat) * (x - yhat) AS sse, se + (x - yhat) AS se
    FROM (
      SELECT *,
             CASE form WHEN 'add' THEN alpha * (x - sv) + (1 - alpha) * (l + b)
                       WHEN 'mul' THEN alpha * (x / sv) + (1 - alpha) * (l + b)
                       WHEN 'none' THEN alpha * x + (1 - alpha) * (l + b)
                       ELSE alpha * x + (1 - alpha) * l END AS l_new,
             CASE form WHEN 'add' THEN l + b + sv
                       WHEN 'mul' THEN (l + b) * sv
                       WHEN 'none' THEN l + b
                       ELSE l END AS yhat
      FROM (SELECT *, vals[t + 1] AS x,
                   CASE WHEN form IN ('add', 'mul') THEN s[(t % 12) + 1] END AS sv
            FROM {fold} WHERE t < len(vals)))"""


def _search(name: str, arrays: str, cands: str) -> str:
    """CTEs ``{name}_fold`` and ``{name}_best`` (lowest SSE, ties by smallest parameters)."""
    fold = f"{name}_fold"
    return f"""
{fold} AS ({_init(arrays, cands)}
    UNION ALL {_STEP.format(fold=fold)}
),
{name}_best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY Country, form
                                 ORDER BY CASE WHEN isnan(sse) OR sse IS NULL THEN 'Infinity'::DOUBLE ELSE sse END,
                                          alpha, beta, gamma) AS rn
    FROM {fold} WHERE t = len(vals))
  WHERE rn = 1
)"""


def _around(name: str, best: str, deltas: str) -> str:
    """CTE ``name``: the candidates around the ones of ``best``."""
    return f"""{name} AS (
  SELECT b.Country, b.form,
         least(greatest(b.alpha + da.d, 0.01), 0.99) AS alpha,
         CASE WHEN b.form = 'simple' THEN 0.0::DOUBLE ELSE least(greatest(b.beta + db.d, 0.01), 0.99) END AS beta,
         CASE WHEN b.form IN ('add', 'mul') THEN least(greatest(b.gamma + dg.d, 0.01), 0.99) ELSE 0.0::DOUBLE END
           AS gamma
  FROM {best} b, (SELECT unnest({deltas}) AS d) da, (SELECT unnest({deltas}) AS d) db,
       (SELECT unnest({deltas}) AS d) dg
  WHERE (b.form <> 'simple' OR db.d = 0.0) AND (b.form IN ('add', 'mul') OR dg.d = 0.0)
)"""


def fit_ctes(series: str, prefix: str) -> str:
    """CTEs ending in ``{prefix}_fit``: best parameters and final state per (Country, form)."""
    arrays = f"{prefix}_arrays"
    return f"""
{arrays} AS (SELECT Country, list(y ORDER BY ds) AS ys, max(ds) AS last_ds, count(*) AS n
             FROM {series} GROUP BY Country),
{prefix}_forms AS (SELECT * FROM (VALUES ('add'), ('mul'), ('none'), ('simple')) t(form)),
{prefix}_coarse AS (
  SELECT a.Country, f.form, al.alpha, be.beta, ga.gamma
  FROM {arrays} a, {prefix}_forms f,
       (SELECT unnest({COARSE}) AS alpha) al,
       (SELECT unnest({COARSE}) AS beta UNION ALL SELECT 0.0::DOUBLE) be,
       (SELECT unnest({COARSE}) AS gamma UNION ALL SELECT 0.0::DOUBLE) ga
  WHERE a.n >= {_FORM_NEED}
    AND ((f.form = 'simple') = (be.beta = 0.0))
    AND ((f.form IN ('add', 'mul')) = (ga.gamma <> 0.0))
),{_search(prefix + "_c", arrays, prefix + "_coarse")},
{_around(prefix + "_fine", prefix + "_c_best", DELTAS)},{_search(prefix + "_f", arrays, prefix + "_fine")},
{_around(prefix + "_finer", prefix + "_f_best", FINER)},{_search(prefix + "_g", arrays, prefix + "_finer")},
{prefix}_fit AS (
  SELECT Country, form, alpha, beta, gamma, sse,
         sqrt(greatest(sse / t - pow(se / t, 2), 0.0)) AS resid_std,
         l AS level, b AS trend, s AS season, CAST(t AS INTEGER) AS steps, CAST(n AS INTEGER) AS n, last_ds
  FROM {prefix}_g_best WHERE sse IS NOT NULL AND isfinite(sse)
)"""


def forecast_select(fit: str, h: str) -> str:
    """h-step forecasts (``h`` an integer literal or column of ``fit``)."""
    return f"""
SELECT Country, form, CAST(k AS INTEGER) AS step, CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds,
       yhat AS forecast, yhat - 1.28::DOUBLE * resid_std AS lower, yhat + 1.28::DOUBLE * resid_std AS upper
FROM (
  SELECT *, CASE form WHEN 'add' THEN level + k * trend + season[((steps + k - 1) % 12) + 1]
                      WHEN 'mul' THEN (level + k * trend) * season[((steps + k - 1) % 12) + 1]
                      WHEN 'none' THEN level + k * trend
                      ELSE level END AS yhat
  FROM (SELECT *, unnest(range(1, {h} + 1)) AS k FROM {fit}))"""
