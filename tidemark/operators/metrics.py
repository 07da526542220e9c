"""Backtest metrics of the forecasts, long form.

``backtest_drift``: one fold; the newest ``horizon`` rows of every series are
held out, the drift model is fitted on the rest and forecasts them.
``backtest_rolling``: many folds; the origin moves back ``stride`` rows at a time. What
a model needs of the rows up to an origin are prefix aggregates, so one window pass
(one exchange, one sort) gives the fits of all origins.

Errors are computed per (series, step) and reduced by one grouped aggregation; the
seven metrics are then unpivoted to the metrics-table layout.
``standard_deviation`` is the sample deviation of the per-step terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away
from tidemark.operators.forecast import WEEK_ORIGIN, z_value

METRIC_NAMES = ("MAE", "MAPE", "SMAPE", "MSE", "MDA", "COVERAGE", "WINKLER")


def backtest_drift(train: DataFrame, *, series_col: str = "series",
                   time_col: str = "week_date", target_col: str = "price",
                   horizon: int = 12, level: float = 0.95, places: int = 4) -> DataFrame:
    """Per (series, step h): actual, previous actual, forecast and bounds."""
    # One exchange and one sort: the fit is a set of window aggregates over the
    # older rows of the same partition, so no row meets another scan of its series.
    y, whole = F.col(target_col), Window.partitionBy(series_col)
    w = whole.orderBy(time_col)
    rows = train.filter(y.isNotNull()).select(
        series_col, time_col, y.alias("_y"), F.lag(y, 1).over(w).alias("prev_actual"),
        (F.count(F.lit(1)).over(whole) - F.row_number().over(w) + 1).alias("_rd"))
    old = F.col("_rd") > horizon
    at, v = F.when(old, F.col(time_col)), F.col("_y")
    fitted = rows.select(
        series_col, "_rd", "_y", "prev_actual",
        F.count(at).over(whole).alias("n"), F.min_by(v, at).over(whole).alias("y_first"),
        F.max_by(v, at).over(whole).alias("y_last"),
        F.stddev_samp(F.when(old, v - F.col("prev_actual"))).over(whole).alias("s"))
    j = (fitted.filter((F.col("_rd") <= horizon) & (F.col("n") >= 3))
         .withColumn("h", F.lit(horizon + 1) - F.col("_rd"))
         .withColumn("d", (F.col("y_last") - F.col("y_first")) / (F.col("n") - 1)))
    h = F.col("h")
    center = F.col("y_last") + h * F.col("d")
    half = F.lit(z_value(level)) * F.col("s") * F.sqrt(h * (F.lit(1.0) + h / (F.col("n") - 1)))
    return j.select(series_col, "h", F.col("_y").alias("actual"), "prev_actual",
                    round_half_away(center, places).alias("forecast"),
                    round_half_away(center - half, places).alias("lower_bound"),
                    round_half_away(center + half, places).alias("upper_bound"))


def origin_fits(train: DataFrame, *, series_col: str, time_col: str, target_col: str,
                horizon: int, model: str = "drift") -> DataFrame:
    """Every row as an origin: ``_y``, ``_left`` (rows after it), ``n`` (rows up to it),
    ``after`` (the next ``horizon`` values) and the model's prefix statistics."""
    y, w = F.col(target_col).cast("double"), Window.partitionBy(series_col).orderBy(time_col)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.datediff(F.col(time_col), F.lit(WEEK_ORIGIN).cast("date")) / F.lit(7.0)
    rows = train.filter(y.isNotNull()).select(
        series_col, time_col, y.alias("_y"), x.alias("_x"), (y - F.lag(y, 1).over(w)).alias("_dy"))
    v = F.col("_y")
    common = [series_col, time_col, "_y", "_x",
              (F.count(F.lit(1)).over(whole) - F.row_number().over(w)).alias("_left"),
              F.count(v).over(upto).alias("n"),
              F.collect_list(v).over(w.rowsBetween(1, horizon)).alias("after")]
    if model == "drift":
        return rows.select(*common, F.first(v).over(upto).alias("y_first"),
                           F.stddev_samp("_dy").over(upto).alias("s"))
    if model == "trend":
        stats = {k: getattr(F, f"regr_{k}")("_y", "_x").over(upto)
                 for k in ("slope", "intercept", "sxx", "syy", "sxy", "avgx")}
        return rows.select(*common, *(c.alias(k) for k, c in stats.items()))
    raise ValueError(f"unknown model {model!r}")


def step_forecast(model: str, h):
    """``(centre, error deviation)`` of step ``h`` after an origin of :func:`origin_fits`."""
    n = F.col("n")
    if model == "drift":
        centre = F.col("_y") + h * ((F.col("_y") - F.col("y_first")) / (n - 1))
        return centre, F.col("s") * F.sqrt(h * (F.lit(1.0) + h / (n - 1)))
    x0 = F.col("_x") + h
    sse = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0))
    off = x0 - F.col("avgx")
    return (F.col("intercept") + F.col("slope") * x0,
            F.sqrt(sse / (n - 2)) * F.sqrt(F.lit(1.0) + F.lit(1.0) / n + off * off / F.col("sxx")))


def fold_steps(fits: DataFrame, *, horizon: int, folds: int, stride: int, model: str,
               min_rows: int) -> DataFrame:
    """``fits`` at the origins of ``folds`` folds (0: the newest), one row a step ``h``."""
    back = F.col("_left") - horizon
    at = fits.filter((back >= 0) & (back % stride == 0) & (back < folds * stride)
                     & (F.col("n") >= min_rows))
    if model == "trend":
        at = at.filter("sxx > 0")
    at = at.withColumn("fold", (back / stride).cast("int")).withColumn(
        "h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    h = F.col("h")
    return (at.withColumn("actual", F.element_at("after", h))
            .withColumn("prev_actual", F.when(h == 1, F.col("_y")).otherwise(F.get("after", h - 2))))


def backtest_rolling(train: DataFrame, *, series_col: str = "series", time_col: str = "week_date",
                     target_col: str = "price", horizon: int = 12, folds: int = 10,
                     stride: int = 4, model: str = "drift", min_rows: int = 3,
                     level: float = 0.95, places: int = 4) -> DataFrame:
    """Per (series, fold, step h): actual, previous actual, forecast and bounds of the
    model fitted on the rows up to the fold's origin. Origins with fewer than ``min_rows``
    rows before them are left out."""
    fits = origin_fits(train, series_col=series_col, time_col=time_col, target_col=target_col,
                       horizon=horizon, model=model)
    steps = fold_steps(fits, horizon=horizon, folds=folds, stride=stride, model=model,
                       min_rows=min_rows)
    center, spread = step_forecast(model, F.col("h"))
    half = F.lit(z_value(level)) * spread
    return steps.select(series_col, "fold", "h", "actual", "prev_actual",
                        round_half_away(center, places).alias("forecast"),
                        round_half_away(center - half, places).alias("lower_bound"),
                        round_half_away(center + half, places).alias("upper_bound"))


def error_metrics(bt: DataFrame, *, series_col: str = "series", alpha: float = 0.05,
                  run_ts=None, places: int = 4, by: tuple[str, ...] = ()) -> DataFrame:
    """Seven metrics per series (and the columns ``by``, such as a fold) in the
    metrics-table layout."""
    y, f = F.col("actual"), F.col("forecast")
    lo, hi, prev = F.col("lower_bound"), F.col("upper_bound"), F.col("prev_actual")
    e = y - f
    one, zero = F.lit(1.0), F.lit(0.0)
    terms = {
        "MAE": F.abs(e),
        "MAPE": F.when(y != 0, F.abs(e / y)),
        "SMAPE": F.when((F.abs(y) + F.abs(f)) != 0, F.lit(2.0) * F.abs(e) / (F.abs(y) + F.abs(f))),
        "MSE": e * e,
        "MDA": F.when(prev.isNotNull(),
                      F.when(F.signum(y - prev) == F.signum(f - prev), one).otherwise(zero)),
        "COVERAGE": F.when((y >= lo) & (y <= hi), one).otherwise(zero),
        "WINKLER": (hi - lo)
                   + F.when(y < lo, F.lit(2.0 / alpha) * (lo - y)).otherwise(zero)
                   + F.when(y > hi, F.lit(2.0 / alpha) * (y - hi)).otherwise(zero),
    }
    aggs = []
    for name in METRIC_NAMES:
        aggs.append(F.avg(terms[name]).alias(f"{name}_v"))
        aggs.append(F.stddev_samp(terms[name]).alias(f"{name}_s"))
    wide = bt.groupBy(series_col, *by).agg(*aggs)
    pairs = ", ".join(f"'{n}', `{n}_v`, `{n}_s`" for n in METRIC_NAMES)
    long = wide.selectExpr(f"`{series_col}` AS series", *(f"`{c}`" for c in by),
                           f"stack({len(METRIC_NAMES)}, {pairs}) AS (error_metric, v, s)")
    ts = F.lit(run_ts).cast("timestamp_ntz") if run_ts is not None else \
        F.current_timestamp().cast("timestamp_ntz")
    return long.select(ts.alias("run_ts"), "series", *by, "error_metric",
                       round_half_away("v", places).alias("metric_value"),
                       round_half_away("s", places).alias("standard_deviation"),
                       F.lit(None).cast("string").alias("logs"))
