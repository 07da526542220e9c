"""The learned forecasts against numpy and plain-Python re-statements."""
import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import bands, metrics, regression, smoothing
from tidemark.operators.forecast import z_value
from tidemark.sources import fixtures as fx

DAY0 = dt.date(2019, 1, 7)
SF = "/root/testdata/sf0.01"


def frame(spark, series):
    data = [(s, DAY0 + dt.timedelta(weeks=i), v) for s, vs in series.items() for i, v in enumerate(vs)]
    random.Random(0).shuffle(data)
    return spark.createDataFrame(data, "series string, week_date date, price double").repartition(5)


def walk(seed, n, season=0):
    rng = random.Random(seed)
    y, out = 10.0, []
    for i in range(n):
        y += rng.gauss(0.01, 0.3) + 0.1 * (10 - y)
        out.append(y + (math.sin(2 * math.pi * i / season) if season else 0))
    return out


def by_series(df):
    out = {}
    for s, ts, f, lo, hi in rows(df, "series", "ts", "forecast", "lower_bound", "upper_bound"):
        out.setdefault(s, []).append((f, lo, hi))
    return out


@pytest.mark.parametrize("lags", [(1, 4), regression.LAGS])
def test_pooled_regression_against_numpy(spark, lags):
    series = {f"s{k}": walk(k, 80 + 17 * k) for k in range(6)} | {"short": walk(9, max(lags))}
    with_nulls = frame(spark, series).unionByName(
        spark.createDataFrame([("s1", dt.date(2018, 1, 1), None)], "series string, week_date date, price double"))
    got = by_series(regression.forecast_lags(with_nulls, lags=lags, horizon=12, places=8))
    x, c, deep = [], [], max(lags)
    for vs in series.values():
        for i in range(deep, len(vs) - 1):
            x.append([1.0] + [vs[i] - vs[i - lag] for lag in lags])
            c.append(vs[i + 1] - vs[i])
    x, c = np.array(x), np.array(c)
    b = np.linalg.lstsq(x, c, rcond=None)[0]
    s = math.sqrt(((c - x @ b) ** 2).sum() / (len(c) - len(b)))
    # The spread by simulation of unit shocks through the recursion.
    def ahead(vs):
        vs = list(vs)
        for _ in range(12):
            vs.append(vs[-1] + b[0] + sum(bj * (vs[-1] - vs[-1 - lag]) for bj, lag in zip(b[1:], lags)))
        return vs[-12:]
    psi = np.array(ahead([0.0] * (deep + 1))) * 0
    shocked, plain = [0.0] * deep + [1.0], [0.0] * (deep + 1)
    psi = np.r_[1.0, (np.array(ahead(shocked)) - np.array(ahead(plain)))[:11]]
    half = z_value(0.95) * s * np.sqrt(np.cumsum(psi ** 2))
    assert set(got) == {k for k, vs in series.items() if len(vs) > deep}
    for k, steps in got.items():
        expected = ahead(series[k])
        for (f, lo, hi), e, w in zip(steps, expected, half):
            assert f == pytest.approx(e, abs=1e-6)
            assert hi - f == pytest.approx(w, rel=1e-6) and f - lo == pytest.approx(w, rel=1e-6)


def test_pooled_regression_degenerate(spark):
    flat = frame(spark, {"a": [5.0] * 30, "b": [7.0] * 30})
    got = by_series(regression.forecast_lags(flat, lags=(1, 2)))
    assert got["a"] == [(5.0, 5.0, 5.0)] * 12 and got["b"][0][0] == 7.0
    empty = flat.limit(0)
    assert regression.forecast_lags(empty, lags=(1, 2)).count() == 0
    assert regression.forecast_lags(frame(spark, {"a": [1.0, 2.0, 3.0, 4.0]}), lags=(1, 2)).count() == 0


def holt_winters(y, m, a, b, g):
    level = sum(y[:m]) / m
    trend = (sum(y[m:2 * m]) / m - level) / m
    season, sse = [v - level for v in y[:m]], 0.0
    for i in range(m, len(y)):
        old = season[i % m]
        sse += (y[i] - level - trend - old) ** 2
        new = a * (y[i] - old) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        season[i % m] = g * (y[i] - new) + (1 - g) * old
        level = new
    return sse, level, trend, season, len(y)


def test_smoothing_against_a_loop(spark):
    m, series = 6, {f"s{k}": walk(k, 40 + 5 * k, season=6) for k in range(5)} | {"short": walk(1, 15)}
    grid = ((0.2, 0.1, 0.1), (0.6, 0.02, 0.3), (0.9, 0.3, 0.5))
    got = by_series(smoothing.forecast_smoothing(frame(spark, series), season=m, grid=grid,
                                                 horizon=14, places=8))
    assert set(got) == set(series) - {"short"}
    chosen = set()
    for k, steps in got.items():
        fits = [(holt_winters(series[k], m, *p), p) for p in grid]
        (sse, level, trend, season, n), (a, b, g) = min(fits, key=lambda x: x[0][0])
        chosen.add((a, b, g))
        for h, (f, lo, hi) in enumerate(steps, 1):
            past = sum((a + a * b * j + (g * (1 - a) if j % m == 0 else 0)) ** 2 for j in range(1, h))
            w = z_value(0.95) * math.sqrt(sse / (n - m) * (1 + past))
            e = level + h * trend + season[(n + h - 1) % m]
            assert f == pytest.approx(e, abs=1e-6) and hi - f == pytest.approx(w, abs=1e-6)
    assert len(chosen) > 1


def test_smoothing_odd_series(spark):
    series = {"flat": [3.0] * 30, "gone": [None] * 30}
    got = by_series(smoothing.forecast_smoothing(frame(spark, series), season=4))
    assert got == {"flat": [(3.0, 3.0, 3.0)] * 12}


@pytest.mark.parametrize("model", ["drift", "trend"])
def test_rolling_folds_against_separate_fits(spark, model):
    series = {f"s{k}": walk(k, 50 + k) for k in range(3)} | {"short": walk(5, 17)}
    bt = metrics.backtest_rolling(frame(spark, series), folds=5, stride=3, horizon=6, model=model,
                                  min_rows=4, places=8)
    got = {(s, k, h): (y, p, f, lo) for s, k, h, y, p, f, lo in rows(
        bt, "series", "fold", "h", "actual", "prev_actual", "forecast", "lower_bound")}
    from tidemark.operators.forecast import forecast_drift, forecast_trend
    seen = 0
    for k in range(5):
        cut = {s: vs[:max(len(vs) - 6 - 3 * k, 0)] for s, vs in series.items()}
        cut = {s: vs for s, vs in cut.items() if len(vs) >= 4}
        fit = forecast_drift if model == "drift" else forecast_trend
        one = by_series(fit(frame(spark, cut), series_col="series", target_col="price", horizon=6,
                            places=8))
        for s, steps in one.items():
            for h, (f, lo, hi) in enumerate(steps, 1):
                y, p, f2, lo2 = got[s, k, h]
                at = len(cut[s]) + h - 1
                assert (y, p) == (series[s][at], series[s][at - 1])
                assert f2 == pytest.approx(f, abs=1e-6) and lo2 == pytest.approx(lo, abs=1e-6)
                seen += 1
    assert seen == len(got)


def test_rolling_folds_are_one_exchange(spark):
    df = spark.createDataFrame([], "series string, week_date date, price double")
    for model in ("drift", "trend"):
        p = metrics.backtest_rolling(df, model=model)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", p)) == 1 and "Join" not in p
        assert len(re.findall(r"\+- Sort |^Sort ", p)) == 1


def test_learned_models_scan_once(spark):
    """What is fitted and what is forecast share one pass over the input."""
    for df in (regression.forecast_lags(fx.many_series(spark, SF)),
               bands.forecast_bands(fx.many_series(spark, SF))):
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
        final = p.split("== Initial Plan ==")[0]
        # Each branch after the first reads the exchange of the first.
        assert len(re.findall(r"ReusedExchange", final)) >= 1, final


@pytest.mark.parametrize("level", [0.8, 0.95])
def test_empirical_bands_cover_held_out_weeks(spark, level):
    """Heavy-tailed changes: a normal band misses, the empirical one covers its level."""
    rng = np.random.default_rng(3)
    series = {f"s{k}": (20 + np.cumsum(rng.standard_t(2.5, 200) * 0.2)).tolist() for k in range(500)}
    history = frame(spark, {s: vs[:-12] for s, vs in series.items()})
    got = by_series(bands.forecast_bands(history, level=level, places=8))
    inside = [lo <= y <= hi for s, steps in got.items()
              for y, (f, lo, hi) in zip(series[s][-12:], steps)]
    assert len(inside) == 6000 and abs(np.mean(inside) - level) <= 0.03


def test_bands_cover_given_series(spark):
    """The given 125 series: forecasts of the last twelve weeks from those before."""
    w = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("week_date")))
    table = fx.many_series(spark, "/root/testdata/sf0.1").filter("price IS NOT NULL").withColumn("rd", w)
    table = table.persist()
    got = by_series(bands.forecast_bands(table.filter("rd > 12")))
    actual = {}
    for s, rd, y in rows(table.filter("rd <= 12"), "series", "rd", "price"):
        actual.setdefault(s, {})[12 - rd] = y
    inside = [lo <= actual[s][h] <= hi for s, steps in got.items() for h, (f, lo, hi) in enumerate(steps)]
    assert len(inside) > 1400 and abs(np.mean(inside) - 0.95) <= 0.03
    table.unpersist()
