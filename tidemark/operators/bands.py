"""Empirical prediction bands (D3): the spread of past forecast errors, step by step.

A band of ``z`` deviations is too narrow where errors have heavier tails than the normal
distribution. Here the bounds are quantiles of errors that the same model has made: it
is fitted at many earlier origins (:func:`tidemark.operators.metrics.origin_fits`), and each
error is divided by the deviation the model expects for its step, which makes the errors of
all series comparable. Quantiles per step come from a sketch that tasks build and Spark
merges (``accuracy`` bounds its size; exact while a step has fewer errors than that), so
what is left is one row a step, whatever the number of series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away
from tidemark.operators.metrics import fold_steps, origin_fits, step_forecast


def error_quantiles(fits: DataFrame, *, horizon: int, folds: int, stride: int, model: str,
                    level: float, min_rows: int, accuracy: int = 10_000) -> DataFrame:
    """``(h, low, high)``: the scaled errors' quantiles that leave out ``1 - level`` in all."""
    steps = fold_steps(fits, horizon=horizon, folds=folds, stride=stride, model=model,
                       min_rows=min_rows)
    center, spread = step_forecast(model, F.col("h"))
    error = F.when(spread > 0, (F.col("actual") - center) / spread)
    tails = F.array(F.lit((1 - level) / 2), F.lit(1 - (1 - level) / 2))
    return (steps.select("h", error.alias("e")).filter("e IS NOT NULL").groupBy("h")
            .agg(F.percentile_approx("e", tails, accuracy).alias("q"))
            .select("h", F.col("q")[0].alias("low"), F.col("q")[1].alias("high")))


def forecast_bands(train: DataFrame, *, series_col: str = "series", time_col: str = "week_date",
                   target_col: str = "price", model: str = "drift", horizon: int = 12,
                   folds: int = 60, stride: int = 2, min_rows: int = 52, level: float = 0.95,
                   places: int = 4) -> DataFrame:
    """Forecasts of the newest origin with bounds from the errors of ``folds`` earlier ones;
    bounds are NULL for steps without any error."""
    fits = origin_fits(train, series_col=series_col, time_col=time_col, target_col=target_col,
                       horizon=horizon, model=model)
    bands = error_quantiles(fits, horizon=horizon, folds=folds, stride=stride, model=model,
                            level=level, min_rows=min_rows)
    newest = fits.filter((F.col("_left") == 0) & (F.col("n") >= 3))
    if model == "trend":
        newest = newest.filter("sxx > 0")
    steps = (newest.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
             .withColumn("ts", F.date_add(F.col(time_col), F.col("h") * 7))
             .join(F.broadcast(bands), "h", "left"))  # `horizon` rows
    center, spread = step_forecast(model, F.col("h"))
    return steps.select(
        F.col(series_col).alias("series"), F.col("ts").cast("timestamp_ntz").alias("ts"),
        round_half_away(center, places).alias("forecast"),
        round_half_away(center + spread * F.col("low"), places).alias("lower_bound"),
        round_half_away(center + spread * F.col("high"), places).alias("upper_bound"))
