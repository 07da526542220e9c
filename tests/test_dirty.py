"""Rows that the driver's tables never hold: NaN, NULL, malformed, second regions."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import lagged_margin, price_moving_avg, price_volatility
from tidemark.operators import forecast as FC
from tidemark.operators.checks import NOT_NULL  # noqa: F401
from tidemark.sources import payload as PL
from tidemark.sources.shaping import flatten_series, pivot_series, weekly_bars
from tests.conftest import rows

NAN = float("nan")
D = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * k) for k in range(8)]


def test_weekly_bars_skip_nan_ticks(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(4)]
    ticks = spark.createDataFrame(
        [("A", days[0], NAN, 1.0), ("A", days[1], 2.0, NAN), ("A", days[2], 5.0, 3.0),
         ("A", days[3], None, None), ("B", days[0], NAN, NAN)],
        "k string, day date, p double, v double")
    got = weekly_bars(ticks, key_cols="k", time_col="day", price_col="p", volume_col="v")
    assert rows(got, "k", "open", "high", "low", "close", "volume") == [
        ("A", 2.0, 5.0, 2.0, 5.0, 4), ("B", None, None, None, None, None)]


def test_large_values_keep_their_row(spark):
    df = spark.createDataFrame([("2024-01-01", v, k) for k, v in enumerate(
        ["1e19", "inf", "nan", "x", "", None, "3.00005"])], "period string, value string, o int")
    got = flatten_series(df, period_col="period", value_col="value", keep_cols=["o"])
    assert rows(got, "o", "price") == [(0, 1e19), (1, float("inf")), (6, 3.0001)]
    wide = pivot_series(df.withColumn("l", F.lit("a")), period_col="period", label_col="l",
                        value_col="value", order_col="o", columns={"a": "a"})
    assert rows(wide, "a") == [(3.0001,)]


def test_rejects_name_every_document_that_lost_something(spark):
    docs = [(1, "{}"), (2, '{"response": {"data": []}}'), (3, "not json"),
            (4, '{"response": {"data": 7}}'),
            (5, '{"response": {"data": [{"period": "p", "value": "1"}, 8]}}'),
            (6, '{"response": {"data": [{"period": "p", "value": "1"}]}}'), (7, None)]
    df = spark.createDataFrame(docs, "id int, body string")
    parsed = PL.parse_payload_text(df, "body", on_error="skip")
    assert [r[0] for r in rows(PL.payload_rejects(parsed, ["id"]), "id")] == [3, 4, 5]
    assert (6, "p", "1") in rows(PL.explode_payload(parsed, ["id"]), "id", "period", "value")


def test_models_stay_within_their_scope(spark):
    nat = spark.createDataFrame(
        [(d, r, 1.0 + k + j, 2.0, 1.5, 1.7) for k, d in enumerate(D)
         for j, r in enumerate(["US_NATIONAL", "WEST"])],
        "week_date date, region string, regular double, diesel double, midgrade double, "
        "premium double")
    bars = spark.createDataFrame([(d, "A", 42.0 * (k + 1)) for k, d in enumerate(D)],
                                 "week_date date, ticker string, close double")
    scope = {"region": "US_NATIONAL"}
    assert {r["region"] for r in price_moving_avg(nat, scope=scope).collect()} == {"US_NATIONAL"}
    assert {r["region"] for r in price_volatility(nat, scope=scope).collect()} == {"US_NATIONAL"}
    assert lagged_margin(nat, bars, ticker="A", scope=scope).count() == len(D)
    assert FC.training_set(nat, scope=scope).count() == len(D)
    fc = FC.forecast_drift(FC.training_set(nat, scope=scope), horizon=2)
    assert FC.history_plus_forecast(nat, fc, scope=scope).count() == len(D) + 2


def test_forecasts_start_after_the_newest_known_price(spark):
    data = [(d, "A", float(k) if k < 6 else None) for k, d in enumerate(D)]
    df = spark.createDataFrame(data, "week_date date, region string, regular double")
    for model in (FC.forecast_drift, FC.forecast_trend):
        got = model(df, horizon=2).orderBy("ts").collect()
        assert [r["forecast"] for r in got] == [6.0, 7.0]
        assert [r["ts"].date() for r in got] == [D[6], D[7]]


def test_pooled_band_covers_held_out_weeks(spark):
    """The band comes from weeks that the fit has not seen: on noise it covers
    about as often as its level says."""
    import random
    rng = random.Random(1)
    data, future = [], {}
    for s in range(60):
        for k in range(100):
            y = 50 + rng.gauss(0, 1)
            t = dt.date(2020, 1, 6) + dt.timedelta(days=7 * k)
            if k < 88:
                data.append((f"s{s}", t, y))
            else:
                future[f"s{s}", t] = y
    df = spark.createDataFrame(data, "series string, week_date date, price double")
    got = FC.forecast_pooled(df, horizon=12).collect()
    hit = [r["lower_bound"] <= future[r["series"], r["ts"].date()] <= r["upper_bound"] for r in got]
    assert len(got) == 60 * 12 and 0.9 < sum(hit) / len(hit) < 0.99
