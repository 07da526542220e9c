"""Seasonal smoothing of each series (D2): additive level, trend and season.

Smoothing depends on the order of the rows, so a series' prices are put in order in
one array (one price a week: its size is bounded by the number of weeks) and folded.
Each series is fitted with every parameter set of a small grid and keeps the one
with the least squared one-step errors. All series are folded independently: the only
shuffle is by series.

With season length ``m`` the start is taken from the first two seasons: level, the mean
of the first; trend, the step between both means over ``m``; season, the first one's
prices less their mean. Folding begins after the first season.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.forecast import _out, z_value

#: (level, trend, season) weights that are tried.
GRID = tuple((a, b, g) for a in (0.2, 0.5, 0.8) for b in (0.02, 0.1) for g in (0.1, 0.3))


def _mean(values: Column, first: int, n: int) -> Column:
    part = F.slice(values, first, n)
    return F.aggregate(part, F.lit(0.0), lambda a, v: a + v) / F.lit(float(n))


def smooth(values: Column, a: Column, b: Column, g: Column, season: int) -> Column:
    """Struct of ``level``, ``trend``, ``season`` (the next step's first), ``sse`` and ``n``
    (one-step errors) after the last of ``values``."""
    base = _mean(values, 1, season)
    start = F.struct(
        base.alias("level"), ((_mean(values, season + 1, season) - base) / season).alias("trend"),
        F.transform(F.slice(values, 1, season), lambda v: v - base).alias("season"),
        F.lit(0.0).alias("sse"), F.lit(0).cast("long").alias("n"))

    def step(s, y):
        old = F.element_at(s["season"], 1)
        error = y - (s["level"] + s["trend"] + old)
        level = a * (y - old) + (1 - a) * (s["level"] + s["trend"])
        trend = b * (level - s["level"]) + (1 - b) * s["trend"]
        return F.struct(
            level.alias("level"), trend.alias("trend"),
            F.concat(F.slice(s["season"], 2, season), F.array(g * (y - level) + (1 - g) * old))
            .alias("season"),
            (s["sse"] + error * error).alias("sse"), (s["n"] + 1).alias("n"))

    return F.aggregate(F.slice(values, F.lit(season + 1), F.size(values)), start, step)


def forecast_smoothing(train: DataFrame, *, series_col: str = "series", time_col: str = "week_date",
                       target_col: str = "price", season: int = 52,
                       grid: Sequence[tuple[float, float, float]] = GRID, horizon: int = 12,
                       level: float = 0.95, places: int = 4) -> DataFrame:
    """Forecasts with bounds of every series of at least ``2 * season + 4`` prices; equal
    squared errors go to the earlier parameter set."""
    y = F.col(target_col).cast("double")
    ordered = (train.filter(y.isNotNull()).groupBy(series_col)
               .agg(F.sort_array(F.collect_list(F.struct(F.col(time_col).alias("t"), y.alias("y"))))
                    .alias("rows"), F.max(time_col).alias("last_t"))
               .filter(F.size("rows") >= 2 * season + 4)
               .select(series_col, "last_t", F.transform("rows", lambda r: r["y"]).alias("values")))
    sets = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(a).alias("a"), F.lit(b).alias("b"),
                              F.lit(g).alias("g")) for k, (a, b, g) in enumerate(grid)))
    # A struct of plain columns: the lambda's variables cannot meet those of the fold.
    tried = ordered.select(series_col, "last_t", "values", F.explode(sets).alias("p")).select(
        series_col, "last_t", "p", smooth(F.col("values"), F.col("p.a"), F.col("p.b"),
                                          F.col("p.g"), season).alias("s"))
    best = tried.groupBy(series_col).agg(F.min_by(
        F.struct("last_t", "p", "s"), F.struct(F.col("s.sse"), F.col("p.k"))).alias("best"))
    steps = best.select(series_col, "best.*").withColumn(
        "h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    steps = steps.withColumn("ts", F.date_add("last_t", F.col("h") * 7))
    h = F.col("h")
    center = (F.col("s.level") + h * F.col("s.trend")
              + F.element_at("s.season", ((h - 1) % season + 1).cast("int")))
    a, b, g = F.col("p.a"), F.col("p.b"), F.col("p.g")
    # The error of step h holds the errors before it with these weights.
    past = F.aggregate(F.sequence(F.lit(1), F.greatest(h - 1, F.lit(1))), F.lit(0.0), lambda t, j: (
        t + F.pow(a + a * b * j + F.when(j % season == 0, g * (1 - a)).otherwise(0.0), F.lit(2.0))))
    spread = F.sqrt(F.col("s.sse") / F.col("s.n")
                    * (1 + F.when(h > 1, past).otherwise(F.lit(0.0))))
    return _out(steps, series_col, center, F.lit(z_value(level)) * spread, places)
