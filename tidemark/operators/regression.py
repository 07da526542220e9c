"""Pooled regression on lag features (D2): one model learned from all series.

The change to the next week is a linear function of ``k`` gaps, the newest price
less the price ``lag`` rows before, plus a constant. The fit needs the normal
equations only: sums of products of features, ``(k + 1)(k + 3) / 2`` numbers and a
count, which Spark adds up in every task before one row is left. Solving them is
the work of one small task; forecasts are folds of the fitted recursion over each
series' newest rows, so a series costs its window and nothing else. No step runs
before the result is asked for, and a series with a third of all rows adds to the
same sums as the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.forecast import _out, z_value

LAGS = (1, 2, 3, 4, 8, 12, 26, 52)
FIT = "b array<double>, spread array<double>, n long"


def lag_rows(train: DataFrame, *, series_col: str, time_col: str, target_col: str,
             lags: Sequence[int]) -> DataFrame:
    """Rows with all lags: series, time, ``past`` (newest last) and ``change`` (NULL for the
    newest row of a series)."""
    y, depth = F.col(target_col).cast("double"), max(lags)
    w = Window.partitionBy(series_col).orderBy(time_col)
    rows = train.filter(y.isNotNull()).select(
        series_col, time_col, F.collect_list(y).over(w.rowsBetween(-depth, 0)).alias("past"),
        (F.lead(y, 1).over(w) - y).alias("change"))
    return rows.filter(F.size("past") == depth + 1)


def _features(past: Column, lags: Sequence[int]) -> list[Column]:
    now = F.element_at(past, -1)
    return [F.lit(1.0), *(now - F.element_at(past, -1 - lag) for lag in lags)]


def solve_moments(moments: np.ndarray, k: int, lags: Sequence[int], horizon: int):
    """``(coefficients, error deviation of steps 1 .. horizon, n)`` from the sums of products
    of ``(1, features, target)``, upper triangle by rows; None if they do not fix a fit."""
    full = np.zeros((k + 2, k + 2))
    full[np.triu_indices(k + 2)] = moments
    full = full + np.triu(full, 1).T
    n = full[0, 0]
    if not n > k + 1:
        return None
    # Equal scales keep the equations well conditioned; the least-norm solution is taken
    # where features depend on each other.
    scale = np.sqrt(np.maximum(np.diag(full)[:-1], 1e-300))
    b = np.linalg.lstsq(full[:-1, :-1] / np.outer(scale, scale), full[:-1, -1] / scale,
                        rcond=1e-13)[0] / scale
    sse = max(full[-1, -1] - 2 * b @ full[:-1, -1] + b @ full[:-1, :-1] @ b, 0.0)
    s = np.sqrt(sse / (n - k - 1))
    # Weights of past errors in the error of a step, by the recursion of the forecast itself.
    psi = [1.0]
    for i in range(1, horizon):
        psi.append((1 + b[1:].sum()) * psi[-1]
                   - sum(c * psi[i - 1 - lag] for c, lag in zip(b[1:], lags) if i - 1 >= lag))
    return b, s * np.sqrt(np.cumsum(np.square(psi))), int(n)


def fit_lags(rows: DataFrame, *, lags: Sequence[int], horizon: int) -> DataFrame:
    """One row: coefficients ``b`` (constant first), ``spread`` of the steps, ``n``."""
    known = F.col("change").isNotNull()
    x = [F.when(known, f) for f in _features(F.col("past"), lags)] + [F.col("change")]
    k = len(lags)
    sums = [F.coalesce(F.sum(x[i] * x[j]), F.lit(0.0)) for i in range(k + 2) for j in range(i, k + 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.column(0).to_pylist():
                found = solve_moments(np.array(row, float), k, lags, horizon)
                if found is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([found[0].tolist()]), pa.array([found[1].tolist()]),
                         pa.array([found[2]])], ["b", "spread", "n"])

    return rows.agg(F.array(*sums).alias("moments")).mapInArrow(run, FIT)


def forecast_lags(train: DataFrame, *, series_col: str = "series", time_col: str = "week_date",
                  target_col: str = "price", lags: Sequence[int] = LAGS, horizon: int = 12,
                  level: float = 0.95, places: int = 4) -> DataFrame:
    """Forecasts of every series that has ``max(lags) + 1`` prices, with bounds; none if all
    series together are too short to fit."""
    rows = lag_rows(train, series_col=series_col, time_col=time_col, target_col=target_col, lags=lags)
    fit = fit_lags(rows, lags=lags, horizon=horizon).select(F.struct("b", "spread")).scalar()
    newest = rows.filter("change IS NULL").select(
        series_col, F.col(time_col).alias("last_t"), "past", fit.alias("fit")).filter(
        F.col("fit").isNotNull())
    b = F.col("fit.b")

    def step(state, _):
        past = state["past"]
        gaps = _features(past, lags)
        new = F.element_at(past, -1)
        for j, g in enumerate(gaps):
            new = new + F.element_at(b, j + 1) * g
        return F.struct(F.concat(F.slice(past, 2, max(lags)), F.array(new)).alias("past"),
                        F.concat(state["out"], F.array(new)).alias("out"))

    start = F.struct(F.col("past").alias("past"), F.array().cast("array<double>").alias("out"))
    out = newest.select(series_col, "last_t", "fit", F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)), start, step)["out"].alias("out"))
    steps = out.select(series_col, "last_t", "fit", F.posexplode("out").alias("k", "center"))
    steps = steps.withColumn("ts", F.date_add("last_t", (F.col("k") + 1) * 7))
    half = F.lit(z_value(level)) * F.element_at("fit.spread", F.col("k") + 1)
    return _out(steps, series_col, F.col("center"), half, places)
