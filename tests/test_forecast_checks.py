import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import checks as CK
from tidemark.operators import forecast as FC
from tidemark.operators import metrics as MT

D0 = dt.date(2024, 1, 1)


def series(spark, data):
    return spark.createDataFrame(
        [(s, D0 + dt.timedelta(days=7 * i), None if y is None else float(y)) for s, i, y in data],
        "series string, week_date date, price double")


def test_drift_and_trend_shapes(spark):
    data = ([("const", i, 2.0) for i in range(10)] + [("line", i, 1.0 + 0.5 * i) for i in range(10)]
            + [("short", i, 1.0) for i in range(2)] + [("empty", i, None) for i in range(5)])
    train = FC.training_set(series(spark, data), series_col="series", target_col="price")
    drift = FC.forecast_drift(train, series_col="series", target_col="price", horizon=3)
    got = {(r["series"], r["ts"].date()): r for r in drift.collect()}
    assert {s for s, _ in got} == {"const", "line"}      # too short / all NULL skipped
    last = D0 + dt.timedelta(days=63)
    c1 = got[("const", last + dt.timedelta(days=7))]
    assert c1["forecast"] == c1["lower_bound"] == c1["upper_bound"] == 2.0
    l3 = got[("line", last + dt.timedelta(days=21))]
    assert l3["forecast"] == 7.0 and l3["lower_bound"] == 7.0   # exact line: zero spread
    trend = FC.forecast_trend(train, series_col="series", target_col="price", horizon=2)
    t = {(r["series"], r["ts"].date()): r for r in trend.collect()}
    assert t[("line", last + dt.timedelta(days=14))]["forecast"] == 6.5
    skipped = FC.skipped_series(train, drift, series_col="series")
    assert sorted(r["series"] for r in skipped.collect()) == ["short"]


def test_interval_order_and_width_grows(spark):
    import random
    rnd = random.Random(7)
    y, data = 3.0, []
    for i in range(60):
        y += rnd.uniform(-0.1, 0.12)
        data.append(("s", i, round(y, 4)))
    train = series(spark, data)
    fc = FC.forecast_drift(train, series_col="series", target_col="price", horizon=12)
    rs = sorted(fc.collect(), key=lambda r: r["ts"])
    assert all(r["lower_bound"] <= r["forecast"] <= r["upper_bound"] for r in rs)
    widths = [r["upper_bound"] - r["lower_bound"] for r in rs]
    assert widths == sorted(widths)
    pooled = FC.forecast_pooled(train, series_col="series", target_col="price", horizon=12)
    ps = pooled.collect()
    assert len(ps) == 12 and all(r["lower_bound"] <= r["forecast"] <= r["upper_bound"] for r in ps)


def test_history_plus_forecast(spark):
    hist = series(spark, [("US", i, 1.0 + i) for i in range(5)] + [("US", 5, None)])
    fc = FC.forecast_drift(FC.training_set(hist, series_col="series", target_col="price"),
                           series_col="series", target_col="price", horizon=2)
    fc = fc.withColumn("series", F.lit('"US"'))
    final = FC.history_plus_forecast(hist, fc, series_col="series", target_col="price")
    out = final.collect()
    assert len(out) == 8                                   # NULL history row kept
    assert {r["region"] for r in out} == {"US"}            # quotes stripped
    assert sum(r["record_type"] == "FORECAST" for r in out) == 2


def test_backtest_metrics_values(spark):
    data = [("s", i, round(1.0 + 0.1 * i, 4)) for i in range(20)]
    bt = MT.backtest_drift(series(spark, data), horizon=4)
    m = {r["error_metric"]: r for r in MT.error_metrics(bt, run_ts="2026-01-12").collect()}
    assert m["MAE"]["metric_value"] == 0.0 and m["COVERAGE"]["metric_value"] == 1.0
    assert m["MDA"]["metric_value"] == 1.0 and m["WINKLER"]["metric_value"] == 0.0
    assert set(m) == set(MT.METRIC_NAMES)


def test_checks_null_passes_accepted(spark):
    df = spark.createDataFrame([("a", 1), (None, None), ("z", 3), ("z", 4), ("y", 5)],
                               "label string, v int")
    chs = [*CK.not_null("t", "label", "v"), CK.accepted_values("t", "label", ["a"])]
    out = {(r["column_name"], r["test_name"]): r for r in CK.run_checks({"t": df}, chs).collect()}
    assert out[("label", "not_null")]["failures"] == 1
    assert out[("v", "not_null")]["status"] == "FAIL"
    acc = out[("label", "accepted_values")]
    assert acc["failures"] == 2 and acc["status"] == "FAIL"   # distinct bad values y, z
    ok = CK.run_checks({"t": df.filter("label = 'a' or label is null")},
                       [CK.accepted_values("t", "label", ["a"])]).first()
    assert ok["status"] == "PASS"
