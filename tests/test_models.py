import datetime as dt

from tidemark.operators import lagged_margin, price_moving_avg, price_volatility, region_spread
from tests.conftest import rows

D0 = dt.date(2024, 1, 1)


def wk(i):
    return D0 + dt.timedelta(days=7 * i)


def _f(x):
    return None if x is None else float(x)


def national(spark, data):
    return spark.createDataFrame(
        [(wk(i), "US", _f(r), None, _f(p), _f(d)) for i, r, p, d in data],
        "week_date date, region string, regular double, midgrade double, premium double, diesel double")


def test_volatility_first_rows(spark):
    one = price_volatility(national(spark, [(0, 3.0, 3.5, 4.0)]))
    r = one.first()
    assert r["regular_wow_change"] is None and r["regular_wow_pct_change"] is None
    assert r["rolling_12wk_stddev"] is None
    assert r["price_direction"] == "Stable" and r["volatility_label"] == "Low Volatility"
    two = price_volatility(national(spark, [(0, 3.0, 3.5, 4.0), (1, 3.1, 3.6, 4.2)]))
    last = sorted(two.collect(), key=lambda x: x["week_date"])[-1]
    assert last["regular_wow_change"] == 0.1 and last["price_direction"] == "Rising"
    assert last["regular_wow_pct_change"] == 3.3333
    assert last["rolling_12wk_stddev"] == 0.0707
    assert last["hist_avg_regular"] == 3.05 and last["price_anomaly"] == 0.05


def test_volatility_gap_counts_rows_and_null_filter(spark):
    # weeks 1, 2, 4, 5 plus a NULL-price week 3 (filtered before the lag)
    df = national(spark, [(1, 3.0, 0, 4.0), (2, 3.2, 0, 4.0), (3, None, 0, 4.0),
                          (4, 3.1, 0, 4.0), (5, 3.1, 0, 4.0)])
    out = {r["week_date"]: r for r in price_volatility(df).collect()}
    assert wk(3) not in out
    assert out[wk(4)]["regular_wow_change"] == -0.1      # against week 2: rows, not weeks
    assert out[wk(4)]["price_direction"] == "Falling"
    assert out[wk(5)]["price_direction"] == "Stable"


def test_volatility_zero_base(spark):
    out = price_volatility(national(spark, [(0, 0.0, 0, 1.0), (1, 1.0, 0, 1.0)]))
    last = sorted(out.collect(), key=lambda x: x["week_date"])[-1]
    assert last["regular_wow_pct_change"] is None and last["regular_wow_change"] == 1.0


def test_volatility_many_series_independent(spark):
    df = spark.createDataFrame(
        [(wk(i), s, float(i) * k, None, None, None) for s, k in (("A", 1), ("B", 2)) for i in range(3)],
        "week_date date, region string, regular double, midgrade double, premium double, diesel double")
    out = price_volatility(df)
    assert rows(out, "region", "week_date", "regular_wow_change") == [
        ("A", wk(0), None), ("A", wk(1), 1.0), ("A", wk(2), 1.0),
        ("B", wk(0), None), ("B", wk(1), 2.0), ("B", wk(2), 2.0)]


def test_moving_avg_partial_frames_and_nulls(spark):
    df = national(spark, [(0, 1.0, 2.0, None), (1, 2.0, 2.5, 3.0), (2, 3.0, 3.5, 4.0),
                          (3, 4.0, 4.0, None), (4, 5.0, 5.0, 5.0), (5, None, 1.0, 1.0)])
    out = {r["week_date"]: r for r in price_moving_avg(df).collect()}
    assert wk(5) not in out
    assert out[wk(0)]["regular_4wk_avg"] == 1.0 and out[wk(0)]["diesel_4wk_avg"] is None
    assert out[wk(4)]["regular_4wk_avg"] == 3.5
    assert out[wk(4)]["diesel_4wk_avg"] == 4.0          # NULL ignored in the mean
    assert out[wk(4)]["regular_52wk_avg"] == 3.0
    assert out[wk(2)]["premium_spread"] == 0.5 and out[wk(2)]["diesel_spread"] == 1.0


def test_margin_lag_and_null_label(spark):
    retail = national(spark, [(i, 3.0, 0, 4.0) for i in range(5)])
    bars = spark.createDataFrame(
        [(wk(i), "CL", 42.0 * (i + 1)) for i in range(1, 5)] + [(wk(0), "XX", 1.0)],
        "week_date date, ticker string, close double")
    out = {r["week_date"]: r for r in lagged_margin(retail, bars, ticker="CL").collect()}
    assert out[wk(0)]["crude_close_usd_bbl"] is None
    assert out[wk(0)]["margin_category"] == "Tight Margin"        # NULL -> last label
    assert out[wk(1)]["crude_lag2_gal"] is None
    assert out[wk(1)]["pump_to_crude_margin"] == 1.0              # same-week fallback
    assert out[wk(3)]["crude_lag2_gal"] == 2.0
    assert out[wk(3)]["pump_to_crude_margin"] == 1.0
    assert out[wk(1)]["margin_category"] == "Normal Margin"


def test_region_spread_rules(spark):
    nat = national(spark, [(0, 3.0, 0, 0), (1, 0.0, 0, 0)])
    reg = spark.createDataFrame(
        [(wk(0), "W", 3.5, "REGULAR_GASOLINE"), (wk(1), "W", 3.0, "REGULAR_GASOLINE"),
         (wk(2), "W", 2.0, "REGULAR_GASOLINE"), (wk(3), "W", 9.0, "DIESEL"),
         (wk(0), "E", 2.95, "REGULAR_GASOLINE")],
        "week_date date, region string, price double, fuel_type string")
    out = {(r["region"], r["week_date"]): r
           for r in region_spread(reg, nat, national_region="US").collect()}
    assert ("W", wk(3)) not in out
    w0, w1, w2 = out[("W", wk(0))], out[("W", wk(1))], out[("W", wk(2))]
    assert w0["price_spread"] == 0.5 and w0["price_spread_pct"] == 16.67
    assert w0["price_category"] == "Significantly Above Average"
    assert w1["price_spread_pct"] is None                   # national 0: no percent
    assert w1["max_spread_seen"] == 3.0
    assert w2["national_price"] is None and w2["price_category"] == "Significantly Below Average"
    assert w2["max_spread_seen"] == 3.0 and w2["regional_4wk_avg"] == 2.8333
    assert out[("E", wk(0))]["price_category"] == "Near National Average"


def test_region_spread_uses_only_national_rows(spark):
    nat = spark.createDataFrame([(wk(0), "US_NATIONAL", 3.0), (wk(0), "OTHER", 9.0)],
                                "week_date date, region string, regular double")
    reg = spark.createDataFrame([(wk(0), "W", 3.2, "REGULAR_GASOLINE")],
                                "week_date date, region string, price double, fuel_type string")
    out = region_spread(reg, nat).collect()
    assert len(out) == 1 and out[0]["national_price"] == 3.0
