"""Per-series forecasts with prediction intervals.

The reference hands its series to a black-box warehouse forecaster. Here the
models are explicit and distributed:

* ``drift``: random walk with drift, fitted per series by one aggregation
  (first / last value, count, deviation of one-step changes);
* ``trend``: straight line by least squares per series (``regr_*``
  aggregates), classical prediction interval;
* ``pooled``: one least-squares line per step over all series at once, direct
  multi-step (see :func:`forecast_pooled`).

Fitting is a ``groupBy(series)`` whose aggregates are all partial, so a
series holding a third of all rows is still combined map-side. The horizon
is produced by ``explode(sequence(1, h))`` on the one-row-per-series fit
(at most ``h`` rows per series, no cross join). Series too short to fit are
skipped, like the reference's ON_ERROR SKIP; :func:`skipped_series` lists them and
:func:`skip_reasons` says why.
"""

from __future__ import annotations

from collections.abc import Mapping
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away
from tidemark.functions.scope import within

# Monday used as the origin of the week index of the trend model.
WEEK_ORIGIN = "2000-01-03"


def z_value(level: float) -> float:
    """Two-sided normal quantile for a central interval of ``level``."""
    return NormalDist().inv_cdf(0.5 + level / 2.0)


def training_set(df: DataFrame, *, series_col: str = "region", time_col: str = "week_date",
                 target_col: str = "regular",
                 scope: Mapping[str, str] | None = None) -> DataFrame:
    """Series, time, target of the rows within ``scope``, NULL targets removed."""
    return (within(df, scope).filter(F.col(target_col).isNotNull())
              .select(series_col, time_col, target_col))


def _horizon(fit: DataFrame, horizon: int, step_days: int = 7) -> DataFrame:
    return (fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
               .withColumn("ts", F.date_add(F.col("last_t"), F.col("h") * F.lit(step_days))))


def _out(df: DataFrame, series_col: str, center, half, places: int) -> DataFrame:
    return df.select(
        F.col(series_col).alias("series"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        round_half_away(center, places).alias("forecast"),
        round_half_away(center - half, places).alias("lower_bound"),
        round_half_away(center + half, places).alias("upper_bound"))


def drift_fit(train: DataFrame, *, series_col: str, time_col: str, target_col: str) -> DataFrame:
    """Per-series drift fit: T, first, last, drift d, deviation s of changes."""
    w = Window.partitionBy(series_col).orderBy(time_col)
    y = F.col(target_col)
    steps = train.filter(y.isNotNull()).select(series_col, time_col, target_col,
                         (y - F.lag(y, 1).over(w)).alias("_dy"))
    return (steps.groupBy(series_col)
                 .agg(F.count(y).alias("n"),
                      F.min_by(y, F.col(time_col)).alias("y_first"),
                      F.max_by(y, F.col(time_col)).alias("y_last"),
                      F.max(time_col).alias("last_t"),
                      F.stddev_samp("_dy").alias("s"))
                 .filter(F.col("n") >= 3)
                 .withColumn("d", (F.col("y_last") - F.col("y_first")) / (F.col("n") - 1)))


def forecast_drift(train: DataFrame, *, series_col: str = "region",
                   time_col: str = "week_date", target_col: str = "regular",
                   horizon: int = 12, level: float = 0.95, places: int = 4) -> DataFrame:
    """f_h = y_T + h d;  half width = z s sqrt(h (1 + h / (T - 1)))."""
    fit = drift_fit(train, series_col=series_col, time_col=time_col, target_col=target_col)
    z = F.lit(z_value(level))
    steps = _horizon(fit, horizon)
    h = F.col("h")
    center = F.col("y_last") + h * F.col("d")
    half = z * F.col("s") * F.sqrt(h * (F.lit(1.0) + h / (F.col("n") - 1)))
    return _out(steps, series_col, center, half, places)


def trend_fit(train: DataFrame, *, series_col: str, time_col: str, target_col: str) -> DataFrame:
    x = (F.datediff(F.col(time_col), F.lit(WEEK_ORIGIN).cast("date")) / F.lit(7.0))
    y = F.col(target_col)
    pts = train.filter(y.isNotNull()).select(series_col, time_col, y.alias("y"), x.alias("x"))
    return (pts.groupBy(series_col)
               .agg(F.regr_count("y", "x").alias("n"),
                    F.regr_slope("y", "x").alias("b"),
                    F.regr_intercept("y", "x").alias("a"),
                    F.regr_sxx("y", "x").alias("sxx"),
                    F.regr_syy("y", "x").alias("syy"),
                    F.regr_sxy("y", "x").alias("sxy"),
                    F.regr_avgx("y", "x").alias("xbar"),
                    F.max("x").alias("last_x"),
                    F.max(time_col).alias("last_t"))
               .filter((F.col("n") >= 3) & (F.col("sxx") > 0)))


def forecast_trend(train: DataFrame, *, series_col: str = "region",
                   time_col: str = "week_date", target_col: str = "regular",
                   horizon: int = 12, level: float = 0.95, places: int = 4) -> DataFrame:
    """Least-squares line in weeks; interval z s sqrt(1 + 1/n + (x0-xbar)^2/Sxx)."""
    fit = trend_fit(train, series_col=series_col, time_col=time_col, target_col=target_col)
    steps = _horizon(fit, horizon)
    x0 = F.col("last_x") + F.col("h")
    center = F.col("a") + F.col("b") * x0
    sse = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0))
    s = F.sqrt(sse / (F.col("n") - 2))
    se = s * F.sqrt(F.lit(1.0) + F.lit(1.0) / F.col("n")
                    + (x0 - F.col("xbar")) * (x0 - F.col("xbar")) / F.col("sxx"))
    return _out(steps, series_col, center, F.lit(z_value(level)) * se, places)


def skipped_series(train: DataFrame, forecast: DataFrame, *, series_col: str) -> DataFrame:
    """Series present in training but absent from the forecast (too short / bad)."""
    have = forecast.select(F.col("series").alias(series_col)).distinct()
    return train.select(series_col).distinct().join(have, on=series_col, how="left_anti")


def skip_reasons(table: DataFrame, forecast: DataFrame, *, series_col: str, target_col: str,
                 least: int = 3) -> DataFrame:
    """The series of ``table`` that ``forecast`` leaves out, with the reason: ``no value``,
    ``fewer than N values`` for a model that needs ``least``, or ``no fit``."""
    have = forecast.select(clean_series_name("series").alias("_have")).distinct()
    counts = table.groupBy(series_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count(target_col).alias("n_values"))
    name = clean_series_name(F.col(series_col).cast("string"))
    reason = (F.when(F.col("n_values") == 0, F.lit("no value"))
              .when(F.col("n_values") < least, F.lit(f"fewer than {least} values"))
              .otherwise(F.lit("no fit")))
    return (counts.join(have, name.eqNullSafe(F.col("_have")), "left_anti")
            .select(F.col(series_col).alias("series"), "n_rows", "n_values", reason.alias("reason")))


def clean_series_name(c="series"):
    """Strip double quotes from series names."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, '"', "")


def history_plus_forecast(history: DataFrame, forecast: DataFrame, *,
                          series_col: str = "region", time_col: str = "week_date",
                          target_col: str = "regular",
                          scope: Mapping[str, str] | None = None) -> DataFrame:
    """History rows within ``scope`` (NULL targets kept) UNION ALL forecast rows."""
    hist = within(history, scope).select(
        F.col(series_col).alias("region"), F.col(time_col).cast("date").alias("week_date"),
        F.col(target_col).cast("double").alias("actual"),
        F.lit(None).cast("double").alias("forecast"),
        F.lit(None).cast("double").alias("lower_bound"),
        F.lit(None).cast("double").alias("upper_bound"),
        F.lit("HISTORICAL").alias("record_type"))
    fut = forecast.select(
        clean_series_name("series").alias("region"), F.col("ts").cast("date").alias("week_date"),
        F.lit(None).cast("double").alias("actual"), "forecast", "lower_bound", "upper_bound",
        F.lit("FORECAST").alias("record_type"))
    return hist.unionByName(fut)


# ------------------------------------------------------------------ pooled --
POOLED_MEAN = 12   # weeks whose mean a price is compared with


def forecast_pooled(train: DataFrame, *, series_col: str = "series",
                    time_col: str = "week_date", target_col: str = "price",
                    horizon: int = 12, level: float = 0.95, places: int = 4) -> DataFrame:
    """One model for all series: the change over ``h`` weeks is a line in the gap
    between the newest price and its series' mean of ``POOLED_MEAN`` weeks.

    The lines are fitted by least squares over the weeks of all series, one line a
    step. The band is ``z`` times the root mean square of errors on held-out
    weeks: a second fit sees only targets older than ``2 * horizon`` rows, and its
    errors are taken where the targets are newer; without such weeks the bounds
    are NULL. All sums come out of one
    partial aggregation, so only ``horizon`` rows exist after it; nothing runs
    before the result is asked for.
    """
    w = Window.partitionBy(series_col).orderBy(time_col)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    y = F.col(target_col)
    # The place from the end without a second sort; both uses of `base` read one exchange.
    back = F.count(F.lit(1)).over(whole) - F.row_number().over(w) + 1
    x = y - F.avg(y).over(w.rowsBetween(1 - POOLED_MEAN, Window.currentRow))
    base = train.filter(y.isNotNull()).select(
        series_col, time_col, y.alias("y"), x.alias("x"), back.alias("rd"),
        *[(F.lead(y, h).over(w) - y).alias(f"l{h}") for h in range(1, horizon + 1)])
    old = F.col("rd") > 3 * horizon
    held = (F.col("rd") > horizon) & (F.col("rd") <= 2 * horizon)
    aggs = []
    for h in range(1, horizon + 1):
        t, x_ = F.col(f"l{h}"), F.col("x")
        t_old, t_held = F.when(old, t), F.when(held, t)
        x_held = F.when(held & t.isNotNull(), x_)
        aggs += [F.regr_slope(t, x_).alias(f"b{h}"), F.regr_intercept(t, x_).alias(f"a{h}"),
                 F.regr_slope(t_old, x_).alias(f"bo{h}"),
                 F.regr_intercept(t_old, x_).alias(f"ao{h}"),
                 F.count(t_held).alias(f"n{h}"), F.sum(t_held).alias(f"t{h}"),
                 F.sum(x_held).alias(f"x{h}"), F.sum(t_held * t_held).alias(f"tt{h}"),
                 F.sum(x_held * x_held).alias(f"xx{h}"), F.sum(t_held * x_held).alias(f"tx{h}")]

    def step(h):
        a, b, n = F.col(f"ao{h}"), F.col(f"bo{h}"), F.col(f"n{h}")
        t, x_, tt, xx, tx = (F.col(f"{k}{h}") for k in ("t", "x", "tt", "xx", "tx"))
        sse = tt + n * a * a + b * b * xx - 2 * a * t - 2 * b * tx + 2 * a * b * x_
        rms = F.when(sse.isNotNull() & (n > 0), F.sqrt(F.greatest(sse, F.lit(0.0)) / n))
        return F.struct(F.lit(h).alias("h"), F.col(f"a{h}").alias("a"),
                        F.col(f"b{h}").alias("b"), rms.alias("rms"))

    lines = base.agg(*aggs).select(F.inline(F.array(*map(step, range(1, horizon + 1)))))
    newest = (base.filter("rd = 1")
              .select(series_col, "y", "x", F.col(time_col).alias("last_t")))
    steps = _horizon(newest, horizon).join(F.broadcast(lines), "h")  # `horizon` rows
    center = F.col("y") + F.col("a") + F.col("b") * F.col("x")
    return _out(steps, series_col, center, F.lit(z_value(level)) * F.col("rms"), places)
