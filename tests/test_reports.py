import datetime as dt

import numpy as np

from tidemark.operators import reports as RP
from tests.conftest import rows

D0 = dt.date(2024, 1, 1)


def wk(i):
    return D0 + dt.timedelta(days=7 * i)


def test_box_stats_matches_linear_interpolation(spark):
    vals = {"A": [1.0, 2.0, 3.0, 4.0, 100.0], "B": [5.0, 5.5, 6.0, 7.0]}
    df = spark.createDataFrame([(k, wk(i), v) for k, vs in vals.items() for i, v in enumerate(vs)]
                               + [("A", wk(9), None)], "region string, w date, p double")
    got = {r["region"]: r for r in RP.box_stats(df, group_col="region", value_col="p").collect()}
    for k, vs in vals.items():
        q1, med, q3 = np.percentile(vs, [25, 50, 75])
        assert (got[k]["q1"], got[k]["median"], got[k]["q3"]) == (q1, med, q3)
        assert got[k]["n"] == len(vs)
    assert got["A"]["n_outliers"] == 1 and got["B"]["n_outliers"] == 0


def test_label_share_and_counts(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "label string")
    out = {r["label"]: r for r in RP.label_share(df, label_col="label").collect()}
    assert out["x"]["pct_weeks"] == 66.67 and out["y"]["pct_weeks"] == 33.33
    counts = RP.table_counts({"a": df, "b": df.limit(0)})
    assert rows(counts) == [("a", 3), ("b", 0)]


def test_latest_value_and_forecast_card(spark):
    df = spark.createDataFrame([("R", wk(0), 1.0), ("R", wk(1), 2.0), ("R", wk(2), None)],
                               "region string, week_date date, price double")
    assert rows(RP.latest_value(df, series_col="region", time_col="week_date",
                                value_col="price")) == [("R", wk(1), 2.0)]
    final = spark.createDataFrame(
        [("US", wk(0), 1.0, None, None, None, "HISTORICAL"),
         ("US", wk(1), None, 1.1, 1.0, 1.2, "FORECAST"),
         ("US", wk(2), None, 1.2, 1.0, 1.4, "FORECAST")],
        "region string, week_date date, actual double, forecast double, lower_bound double, "
        "upper_bound double, record_type string")
    assert rows(RP.forecast_card(final)) == [("US", wk(2), 1.2, 1.0, 1.4)]
    assert rows(RP.forecast_card(final, step="first")) == [("US", wk(1), 1.1, 1.0, 1.2)]


def test_relation_stats_and_ranking(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(10)] + [(None, 1.0)],
                               "x double, y double")
    r = RP.relation_stats(df, x="x", y="y").first()
    assert (r["n_pairs"], r["correlation"], r["slope"], r["intercept"]) == (10, 1.0, 2.0, 1.0)
    cmp = spark.createDataFrame([("A", 10.0), ("A", 20.0), ("B", -5.0), ("C", 30.0)],
                                "region string, price_spread_pct double")
    ranks = {x["region"]: x["spread_rank"] for x in RP.region_ranking(cmp).collect()}
    assert ranks == {"C": 1, "A": 2, "B": 3}


def test_ticker_overview(spark):
    bars = spark.createDataFrame(
        [("T", wk(0), 1.0, 1.0, 1.0, 10.0, 5), ("T", wk(1), 1.0, 1.0, 1.0, 11.0, 6),
         ("U", wk(0), 1.0, 1.0, 1.0, 4.0, 1)],
        "ticker string, week_date date, open double, high double, low double, close double, "
        "volume long")
    out = {r["ticker"]: r for r in RP.ticker_overview(bars).collect()}
    assert out["T"]["week_date"] == wk(1) and out["T"]["prev_close"] == 10.0
    assert out["T"]["change"] == 1.0 and out["T"]["change_pct"] == 10.0
    assert out["U"]["prev_close"] is None and out["U"]["change_pct"] is None


def test_box_stats_approx_close_to_exact(spark):
    df = spark.range(2000).selectExpr("cast(id % 3 as string) AS g", "cast(id AS double) AS p")
    ex = {r["g"]: r for r in RP.box_stats(df, group_col="g", value_col="p").collect()}
    ap = {r["g"]: r for r in RP.box_stats(df, group_col="g", value_col="p", exact=False).collect()}
    for g in ex:
        assert abs(ex[g]["median"] - ap[g]["median"]) <= 3.0
