"""Forecast intervals and error metrics against direct numpy formulas."""

import datetime as dt
import math
import random
from statistics import NormalDist

import numpy as np

from tidemark.operators import forecast as FC
from tidemark.operators import metrics as MT
from tidemark.plans.upsert import stage
from tidemark.schemas import NATIONAL
from tidemark.sources.shaping import conform

D0 = dt.date(2020, 1, 6)
Z = NormalDist().inv_cdf(0.975)


def _series(spark, ys, name="s"):
    return spark.createDataFrame(
        [(name, D0 + dt.timedelta(days=7 * i), float(y)) for i, y in enumerate(ys)],
        "series string, week_date date, price double")


def test_trend_interval_matches_ols(spark):
    rnd = random.Random(5)
    ys = [round(2 + 0.03 * i + rnd.gauss(0, 0.1), 4) for i in range(40)]
    out = FC.forecast_trend(_series(spark, ys), series_col="series", target_col="price",
                            horizon=3).collect()
    origin = (D0 - dt.date(2000, 1, 3)).days / 7.0
    x = np.array([origin + i for i in range(40)])
    y = np.array(ys)
    b, a = np.polyfit(x, y, 1)
    resid = y - (a + b * x)
    s = math.sqrt((resid ** 2).sum() / (len(y) - 2))
    sxx = ((x - x.mean()) ** 2).sum()
    for r in sorted(out, key=lambda r: r["ts"]):
        h = (r["ts"].date() - (D0 + dt.timedelta(days=7 * 39))).days // 7
        x0 = x[-1] + h
        f = a + b * x0
        hw = Z * s * math.sqrt(1 + 1 / len(y) + (x0 - x.mean()) ** 2 / sxx)
        assert abs(r["forecast"] - f) < 1e-4
        assert abs(r["upper_bound"] - (f + hw)) < 1e-4 and abs(r["lower_bound"] - (f - hw)) < 1e-4


def test_metrics_match_numpy(spark):
    rnd = random.Random(9)
    ys = [round(3 + rnd.gauss(0, 0.2), 4) for _ in range(30)]
    bt = MT.backtest_drift(_series(spark, ys), horizon=6)
    rows = sorted(bt.collect(), key=lambda r: r["h"])
    y = np.array([r["actual"] for r in rows])
    f = np.array([r["forecast"] for r in rows])
    lo = np.array([r["lower_bound"] for r in rows])
    hi = np.array([r["upper_bound"] for r in rows])
    prev = np.array([r["prev_actual"] for r in rows])
    e = y - f
    expect = {
        "MAE": np.abs(e), "MAPE": np.abs(e / y), "SMAPE": 2 * np.abs(e) / (np.abs(y) + np.abs(f)),
        "MSE": e * e, "MDA": (np.sign(y - prev) == np.sign(f - prev)).astype(float),
        "COVERAGE": ((y >= lo) & (y <= hi)).astype(float),
        "WINKLER": (hi - lo) + np.where(y < lo, 40 * (lo - y), 0) + np.where(y > hi, 40 * (y - hi), 0),
    }
    got = {r["error_metric"]: r for r in MT.error_metrics(bt, run_ts="2026-01-12").collect()}
    for name, terms in expect.items():
        assert abs(got[name]["metric_value"] - terms.mean()) < 1e-4, name
        assert abs(got[name]["standard_deviation"] - terms.std(ddof=1)) < 1e-4, name


def test_stage_and_conform(spark):
    batch = spark.createDataFrame([("2024-01-01", "US_NATIONAL", "3.1")],
                                  "week_date string, region string, regular string")
    st = stage(batch, NATIONAL, run_ts="2026-01-05 00:00:00",
               defaults={"price_unit": "USD_PER_GALLON", "source": "EIA_WEEKLY"}).first()
    assert st["week_date"] == dt.date(2024, 1, 1) and st["regular"] == 3.1
    assert st["midgrade"] is None and st["price_unit"] == "USD_PER_GALLON"
    assert st["load_ts"] == dt.datetime(2026, 1, 5)
    c = conform(batch.withColumnRenamed("regular", "reg_price"), NATIONAL,
                renames={"reg_price": "regular"})
    assert c.columns == [f.name for f in NATIONAL.fields] and c.first()["regular"] == 3.1
