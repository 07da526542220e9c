import datetime as dt

from pyspark.sql import functions as F

from tidemark.sources.shaping import (
    clean_bars,
    flatten_series,
    latest_per_series,
    pivot_series,
    select_series,
    trailing_window,
    weekly_bars,
)
from tests.conftest import rows

COLS = {"reg": "regular", "dsl": "diesel"}


def _long(spark, data):
    return spark.createDataFrame(data, "label string, period string, value string, pos int")


def test_pivot_last_wins_and_bad_value_keeps_row(spark):
    df = _long(spark, [
        ("reg", "2024-01-01", "3.1", 0),
        ("reg", "2024-01-01", "3.2", 1),      # later duplicate overwrites
        ("reg", "2024-01-08", "x", 2),        # unparseable: row kept, cell NULL
        ("dsl", "2024-01-01", "4.00005", 3),  # rounded half away
        ("dsl", "2024-01-01", "oops", 4),     # unparseable later value keeps the old one
        ("reg", "", "1.0", 5),                # empty period skipped
        ("reg", None, "1.0", 6),              # NULL period skipped
        ("dsl", "2024-01-15", None, 7),       # NULL value skipped (no row)
    ])
    out = pivot_series(df, period_col="period", label_col="label", value_col="value",
                       order_col="pos", columns=COLS)
    assert rows(out, "period", "regular", "diesel") == [
        ("2024-01-01", 3.2, 4.0001), ("2024-01-08", None, None)]


def test_flatten_drops_bad_values(spark):
    df = _long(spark, [("r1", "2024-01-01", "3.1", 0), ("r1", "2024-01-08", "x", 1),
                       ("r1", "2024-01-15", "", 2), ("r1", "", "2.0", 3),
                       ("r1", "2024-01-22", None, 4), ("r1", "2024-01-01", "3.3", 5)])
    out = flatten_series(df, period_col="period", value_col="value", keep_cols=["label"])
    # no de-duplication on the regional path
    assert rows(out, "period", "price") == [("2024-01-01", 3.1), ("2024-01-01", 3.3)]


def test_clean_bars_nan_rules(spark):
    nan = float("nan")
    df = spark.createDataFrame([
        (dt.datetime(2024, 1, 1, 5), "T", nan, 2.0, 1.0, 1.23456, 10.7),
        (dt.datetime(2024, 1, 8), "T", 1.0, 2.0, 1.0, nan, 5.0),
        (dt.datetime(2024, 1, 15), "T", 1.0, 2.0, 1.0, None, 5.0),
        (dt.datetime(2024, 1, 22), "T", 1.0, nan, 1.0, 1.5, nan),
    ], "week_date timestamp_ntz, ticker string, open double, high double, low double, "
       "close double, volume double")
    out = clean_bars(df)
    got = rows(out, "week_date", "open", "high", "close", "volume")
    assert got == [(dt.date(2024, 1, 1), None, 2.0, 1.2346, 10),
                   (dt.date(2024, 1, 22), 1.0, None, 1.5, None)]


def test_latest_per_series(spark):
    df = spark.createDataFrame([(s, w) for s in ("a", "b") for w in range(10)] + [("c", 1)],
                               "s string, w int")
    out = latest_per_series(df, "s", "w", 3)
    assert rows(out) == [("a", 7), ("a", 8), ("a", 9), ("b", 7), ("b", 8), ("b", 9), ("c", 1)]


def test_select_series(spark):
    df = spark.createDataFrame([("S1", 1), ("S2", 2), ("S3", 3)], "id string, v int")
    out = select_series(df, "id", {"S1": "one", "S3": "three"}, "label")
    assert rows(out, "id", "label") == [("S1", "one"), ("S3", "three")]


def test_weekly_bars(spark):
    df = spark.createDataFrame([
        ("T", dt.date(2024, 1, 1), 10.0, 1), ("T", dt.date(2024, 1, 3), 12.0, 2),
        ("T", dt.date(2024, 1, 5), 9.0, 3), ("T", dt.date(2024, 1, 7), 11.0, 4),
        ("T", dt.date(2024, 1, 8), 20.0, 5)], "ticker string, day date, p double, n long")
    out = weekly_bars(df, key_cols=["ticker"], time_col="day", price_col="p", volume_col="n")
    assert rows(out, "week_date", "open", "high", "low", "close", "volume") == [
        (dt.date(2024, 1, 1), 10.0, 12.0, 9.0, 11.0, 10),
        (dt.date(2024, 1, 8), 20.0, 20.0, 20.0, 20.0, 5)]


def test_trailing_window(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 6),), (dt.date(2021, 1, 4),),
                                (dt.date(2024, 1, 1),), (dt.date(2024, 6, 3),)], "w date")
    assert len(trailing_window(df, time_col="w", months=48).collect()) == 3
    assert len(trailing_window(df, time_col="w", months=12, as_of="2024-06-30").collect()) == 2
