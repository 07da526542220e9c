"""Registered queries of the learned forecasts and their evaluation, with DuckDB twins.

The twins work another way than the Spark side: lags are self-joins on row numbers, the
normal equations are solved by elimination steps of a recursive query, smoothing and
forecast recursions are recursive queries that go a row further each time, and a fold's
fit is an aggregate over a self-join of all rows up to its origin.
"""

from __future__ import annotations

from tidemark import oracle as O
from tidemark.operators import bands as BD
from tidemark.operators import forecast as FC
from tidemark.operators import metrics as MT
from tidemark.operators import regression as RG
from tidemark.operators import smoothing as SM
from tidemark.sources import fixtures as fx

R, W = O.R, O.with_

HORIZON, LEVEL = 12, 0.95
TWO_LAGS = (1, 4)
SEASON = 52
ONE_SET = ((0.5, 0.02, 0.1),)
FOLDS, STRIDE = 10, 4
BAND_FOLDS, BAND_STRIDE, BAND_ROWS = 60, 2, 52
RUN_TS = "2026-01-12 00:00:00"
ZSQL = f"cast({FC.z_value(LEVEL)!r} AS double)"


def _backtest_folds(s, d, model):
    bt = MT.backtest_rolling(fx.many_series(s, d), horizon=HORIZON, folds=FOLDS, stride=STRIDE,
                             model=model)
    return MT.error_metrics(bt, by=("fold",), run_ts=RUN_TS)


SPARK = {
    "forecast_two_lags": lambda s, d: RG.forecast_lags(
        fx.many_series(s, d), lags=TWO_LAGS, horizon=HORIZON, level=LEVEL),
    "forecast_lags": lambda s, d: RG.forecast_lags(
        fx.many_series(s, d), horizon=HORIZON, level=LEVEL),
    "forecast_smoothing_fixed": lambda s, d: SM.forecast_smoothing(
        fx.many_series(s, d), season=SEASON, grid=ONE_SET, horizon=HORIZON, level=LEVEL),
    "forecast_smoothing": lambda s, d: SM.forecast_smoothing(
        fx.many_series(s, d), season=SEASON, horizon=HORIZON, level=LEVEL),
    "backtest_folds_drift": lambda s, d: _backtest_folds(s, d, "drift"),
    "backtest_folds_trend": lambda s, d: _backtest_folds(s, d, "trend"),
    "forecast_bands": lambda s, d: BD.forecast_bands(
        fx.many_series(s, d), horizon=HORIZON, folds=BAND_FOLDS, stride=BAND_STRIDE,
        min_rows=BAND_ROWS, level=LEVEL),
    "forecast_skipped": lambda s, d: FC.skip_reasons(
        fx.many_series(s, d), SPARK["forecast_smoothing_fixed"](s, d), series_col="series",
        target_col="price", least=2 * SEASON + 4),
}

_NUMBERED = """n AS (
  SELECT series, week_date AS t, cast(price AS double) AS y,
    row_number() OVER (PARTITION BY series ORDER BY week_date) AS i,
    count(*) OVER (PARTITION BY series) AS total
  FROM fx_many WHERE price IS NOT NULL)"""


def _steps(name: str, center: str, low: str, high: str, src: str, last: str = "t") -> str:
    return f"""SELECT {name}, cast({last} + cast(7 * h AS integer) AS timestamp) AS ts,
  {R(center)} AS forecast, {R(low)} AS lower_bound, {R(high)} AS upper_bound FROM {src}"""


def sql_lags(lags) -> str:
    k, deep = len(lags), max(lags)
    gaps = ", ".join(f"n.y - l{j}.y AS x{j}" for j in range(1, k + 1))
    joins = " ".join(f"JOIN n l{j} ON l{j}.series = n.series AND l{j}.i = n.i - {lag}"
                     for j, lag in enumerate(lags, 1))
    x = ["1.0", *(f"x{j}" for j in range(1, k + 1)), "c"]
    matrix = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in x) + "]" for a in x[:-1])
    fitted = " + ".join(f"b[{j + 1}] * {v}" for j, v in enumerate(x[:-1]))
    step = " + ".join([f"past[{deep + 1}] + b[1]"] + [
        f"b[{j + 1}] * (past[{deep + 1}] - past[{deep + 1 - lag}])" for j, lag in enumerate(lags, 1)])
    total = " + ".join(["1"] + [f"b[{j + 1}]" for j in range(1, k + 1)])
    before = " ".join(f"- CASE WHEN len(psi) > {lag} THEN b[{j + 1}] * psi[len(psi) - {lag}] ELSE 0 END"
                      for j, lag in enumerate(lags, 1))
    return f"""{_NUMBERED},
x AS (SELECT n.series, n.t, n.i, {gaps}, e.y - n.y AS c FROM n {joins}
  LEFT JOIN n e ON e.series = n.series AND e.i = n.i + 1),
elim(k, m) AS (
  SELECT 1, [{matrix}] FROM x WHERE c IS NOT NULL
  UNION ALL
  SELECT k + 1, list_transform(range(1, {k + 2}), lambda r: CASE WHEN r = k
    THEN list_transform(m[r], lambda v: v / m[k][k])
    ELSE list_transform(range(1, {k + 3}), lambda q: m[r][q] - m[r][k] * m[k][q] / m[k][k]) END)
  FROM elim WHERE k <= {k + 1}),
fit AS (SELECT list_transform(m, lambda row: row[{k + 2}]) AS b FROM elim WHERE k = {k + 2}),
err AS (SELECT sqrt(sum((c - ({fitted})) * (c - ({fitted}))) / (count(*) - {k + 1})) AS s
  FROM x, fit WHERE c IS NOT NULL),
weights(h, psi) AS (
  SELECT 1, [1.0::DOUBLE] UNION ALL
  SELECT h + 1, list_append(psi, ({total}) * psi[len(psi)] {before}) FROM weights, fit
  WHERE h < {HORIZON}),
spread AS (SELECT h, s * sqrt(list_sum(list_transform(psi, lambda p: p * p))) AS s FROM weights, err),
ahead(series, t, h, past) AS (
  SELECT n.series, n.t, 0, (SELECT list(o.y ORDER BY o.i) FROM n o
    WHERE o.series = n.series AND o.i >= n.i - {deep})
  FROM n WHERE n.i = n.total AND n.total > {deep}
  UNION ALL
  SELECT series, t, h + 1, list_append(past[2:], {step}) FROM ahead, fit WHERE h < {HORIZON}),
out AS (SELECT a.series, a.t, a.h, a.past[{deep + 1}] AS c, {ZSQL} * p.s AS w
  FROM ahead a JOIN spread p USING (h))
{_steps('series', 'c', 'c - w', 'c + w', 'out')}"""


def sql_smoothing(grid) -> str:
    sets = ", ".join(f"({k}, {a}::DOUBLE, {b}::DOUBLE, {g}::DOUBLE)" for k, (a, b, g) in enumerate(grid))
    m = SEASON
    return f"""{_NUMBERED},
sets(k, a, b, g) AS (VALUES {sets}),
starts AS (
  SELECT series, max(total) AS total, max(t) AS t, avg(y) FILTER (WHERE i <= {m}) AS one,
    avg(y) FILTER (WHERE i > {m} AND i <= {2 * m}) AS two,
    list(y ORDER BY i) FILTER (WHERE i <= {m}) AS first
  FROM n GROUP BY series HAVING max(total) >= {2 * m + 4}),
s(series, k, i, level, trend, season, sse) AS (
  SELECT series, k, {m}, one, (two - one) / {m}, list_transform(first, lambda v: v - one), 0.0::DOUBLE
  FROM starts, sets
  UNION ALL
  SELECT series, k, i, now, b * (now - level) + (1 - b) * trend,
    list_append(season[2:], g * (y - now) + (1 - g) * season[1]),
    sse + (y - (level + trend + season[1])) * (y - (level + trend + season[1]))
  FROM (SELECT s.series, s.k, n.i, level, trend, season, sse, y, b, g,
      a * (y - season[1]) + (1 - a) * (level + trend) AS now
    FROM s JOIN n ON n.series = s.series AND n.i = s.i + 1 JOIN sets USING (k))),
best AS (
  SELECT s.*, x.total, x.t, row_number() OVER (PARTITION BY s.series ORDER BY sse, k) AS place
  FROM s JOIN starts x ON x.series = s.series AND x.total = s.i),
out AS (
  SELECT series, t, h, level + h * trend + season[(h - 1) % {m} + 1] AS c,
    {ZSQL} * sqrt(sse / (total - {m}) * (1 + coalesce(list_sum(list_transform(range(1, h), lambda j:
      pow(a + a * b * j + CASE WHEN j % {m} = 0 THEN g * (1 - a) ELSE 0 END, 2))), 0))) AS w
  FROM (SELECT *, unnest(range(1, {HORIZON + 1})) AS h FROM best JOIN sets USING (k)
        WHERE place = 1))
{_steps('series', 'c', 'c - w', 'c + w', 'out')}"""


def _fold_fits(folds: int, stride: int, min_rows: int) -> str:
    """Fits at the origins: aggregates over a self-join with all rows up to each."""
    x = f"datediff('day', DATE '{FC.WEEK_ORIGIN}', {{}}.t)::DOUBLE / 7.0::DOUBLE"
    return f"""{_NUMBERED},
origin AS (
  SELECT series, t, y, i, ((total - i) - {HORIZON}) // {stride} AS fold FROM n
  WHERE (total - i) >= {HORIZON} AND ((total - i) - {HORIZON}) % {stride} = 0
    AND (total - i) - {HORIZON} < {folds * stride} AND i >= {min_rows}
  UNION ALL SELECT series, t, y, i, -1 FROM n WHERE i = total AND total >= 3),
fits AS (
  SELECT o.series, o.fold, o.i, o.t, o.y, count(*) AS n, arg_min(p.y, p.i) AS y_first,
    stddev_samp(p.y - e.y) AS s, {x.format('o')} AS x, regr_slope(p.y, {x.format('p')}) AS b,
    regr_intercept(p.y, {x.format('p')}) AS a, regr_sxx(p.y, {x.format('p')}) AS sxx,
    regr_syy(p.y, {x.format('p')}) AS syy, regr_sxy(p.y, {x.format('p')}) AS sxy,
    regr_avgx(p.y, {x.format('p')}) AS xbar
  FROM origin o JOIN n p ON p.series = o.series AND p.i <= o.i
  LEFT JOIN n e ON e.series = p.series AND e.i = p.i - 1
  GROUP BY o.series, o.fold, o.i, o.t, o.y)"""


_DRIFT = ("y + h * ((y - y_first) / (n - 1))", "s * sqrt(h * (1.0 + h / (n - 1)))")
_TREND = ("a + b * (x + h)",
          "sqrt(greatest(syy - sxy * sxy / sxx, 0.0) / (n - 2)) "
          "* sqrt(1.0 + 1.0 / n + ((x + h) - xbar) * ((x + h) - xbar) / sxx)")


def _fold_rows(model) -> str:
    center, spread = model
    return f"""steps AS (
  SELECT f.*, v.y AS actual, u.y AS prev_actual
  FROM (SELECT series, fold, h, i, t, {center} AS c, {spread} AS w
        FROM (SELECT *, unnest(range(1, {HORIZON + 1})) AS h FROM fits)) f
  LEFT JOIN n v ON v.series = f.series AND v.i = f.i + f.h
  LEFT JOIN n u ON u.series = f.series AND u.i = f.i + f.h - 1)"""


def sql_folds(model, metrics: str) -> str:
    return W(O.FX_MANY, _fold_fits(FOLDS, STRIDE, 3), _fold_rows(model), f"""bt AS (
  SELECT series, fold::INTEGER AS fold, h, actual, prev_actual, {R('c')} AS forecast,
    {R(f'c - {ZSQL} * w')} AS lower_bound, {R(f'c + {ZSQL} * w')} AS upper_bound
  FROM steps WHERE fold >= 0)""") + metrics


def sql_bands() -> str:
    low, high = (1 - LEVEL) / 2, 1 - (1 - LEVEL) / 2
    return W(O.FX_MANY, _fold_fits(BAND_FOLDS, BAND_STRIDE, BAND_ROWS), _fold_rows(_DRIFT), f"""q AS (
  SELECT h, quantile_disc((actual - c) / w, {low!r}) AS low,
    quantile_disc((actual - c) / w, {high!r}) AS high
  FROM steps WHERE fold >= 0 AND w > 0 GROUP BY h)""") + _steps(
        "series", "c", "c + w * low", "c + w * high",
        "(SELECT * FROM steps LEFT JOIN q USING (h) WHERE fold = -1)")


def _many(text: str) -> str:
    return W(O.FX_MANY, text).replace("WITH ", "WITH RECURSIVE ", 1)


def sql(metrics) -> dict[str, str]:
    """``metrics(by)``: the seven metrics of a table ``bt`` by series and the columns ``by``."""
    return {
        "forecast_two_lags": _many(sql_lags(TWO_LAGS)),
        "forecast_lags": _many(sql_lags(RG.LAGS)),
        "forecast_smoothing_fixed": _many(sql_smoothing(ONE_SET)),
        "forecast_smoothing": _many(sql_smoothing(SM.GRID)),
        "backtest_folds_drift": sql_folds(_DRIFT, metrics(("fold",))),
        "backtest_folds_trend": sql_folds(_TREND, metrics(("fold",))),
        "forecast_bands": sql_bands(),
        "forecast_skipped": W(O.FX_MANY) + f"""SELECT series, count(*) AS n_rows,
  count(price) AS n_values, CASE WHEN count(price) = 0 THEN 'no value'
    ELSE 'fewer than {2 * SEASON + 4} values' END AS reason
FROM fx_many GROUP BY series HAVING count(price) < {2 * SEASON + 4}""",
    }
