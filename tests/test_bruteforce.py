"""Models against a straightforward pandas re-statement on random series.

Many small series with gaps, NULL prices and ties; Spark results must equal
the row-by-row rules (after the same half-away-from-zero rounding).
"""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest

from tidemark.operators import price_moving_avg, price_volatility, region_spread


def rnd(x, n=4):
    if x is None or pd.isna(x):
        return None
    return float(Decimal(repr(float(x))).quantize(Decimal(10) ** -10, ROUND_HALF_UP)
                 .quantize(Decimal(10) ** -n, ROUND_HALF_UP))


def make(seed, n_series=6, n_weeks=40):
    r = random.Random(seed)
    out = []
    for s in range(n_series):
        p = r.uniform(2, 4)
        for w in range(n_weeks):
            if r.random() < 0.1:
                continue                               # missing week (gap)
            p += r.choice([-0.2, -0.05, 0.0, 0.05, 0.2]) * r.random()
            reg = None if r.random() < 0.08 else round(p, 4)
            dsl = None if r.random() < 0.2 else round(p + 0.5, 4)
            out.append((f"S{s}", dt.date(2020, 1, 6) + dt.timedelta(days=7 * w), reg,
                        round(p + 0.3, 4), round(p + 0.6, 4), dsl))
    return out


COLS = ["region", "week_date", "regular", "midgrade", "premium", "diesel"]


@pytest.mark.parametrize("seed", [1, 2])
def test_moving_avg_brute_force(spark, seed):
    data = make(seed)
    df = spark.createDataFrame(data, "region string, week_date date, regular double, "
                                     "midgrade double, premium double, diesel double")
    got = {(r["region"], r["week_date"]): r.asDict() for r in price_moving_avg(df).collect()}
    pdf = pd.DataFrame(data, columns=COLS)
    pdf = pdf[pdf.regular.notna()].sort_values(["region", "week_date"])
    n = 0
    for _, g in pdf.groupby("region"):
        for w in (4, 12, 52):
            g[f"r{w}"] = g.regular.rolling(w, min_periods=1).mean()
            g[f"d{w}"] = g.diesel.rolling(w, min_periods=1).mean()
        for _, row in g.iterrows():
            s = got[(row.region, row.week_date)]
            for w in (4, 12, 52):
                assert s[f"regular_{w}wk_avg"] == rnd(row[f"r{w}"])
                assert s[f"diesel_{w}wk_avg"] == rnd(row[f"d{w}"])
            assert s["premium_spread"] == rnd(row.premium - row.regular)
            n += 1
    assert n == len(got)


@pytest.mark.parametrize("seed", [3, 4])
def test_volatility_brute_force(spark, seed):
    data = make(seed)
    df = spark.createDataFrame(data, "region string, week_date date, regular double, "
                                     "midgrade double, premium double, diesel double")
    got = {(r["region"], r["week_date"]): r.asDict() for r in price_volatility(df).collect()}
    pdf = pd.DataFrame(data, columns=COLS)
    pdf = pdf[pdf.regular.notna()].sort_values(["region", "week_date"])
    for _, g in pdf.groupby("region"):
        prev = g.regular.shift(1)
        sd = g.regular.rolling(12, min_periods=2).std(ddof=1)
        mean = g.regular.mean()
        for i, (_, row) in enumerate(g.iterrows()):
            s = got[(row.region, row.week_date)]
            pv = prev.iloc[i]
            ch = rnd(row.regular - pv) if pd.notna(pv) else None
            assert s["regular_wow_change"] == ch
            pct = rnd((row.regular - pv) / pv * 100) if pd.notna(pv) and pv > 0 else None
            assert s["regular_wow_pct_change"] == pct
            assert s["hist_avg_regular"] == rnd(mean)
            want_dir = "Rising" if ch is not None and ch > 0.05 else (
                "Falling" if ch is not None and ch < -0.05 else "Stable")
            assert s["price_direction"] == want_dir
            v = sd.iloc[i]
            assert s["rolling_12wk_stddev"] == (rnd(v) if pd.notna(v) else None)
            lab = "Low Volatility" if pd.isna(v) else (
                "High Volatility" if v > 0.30 else "Moderate Volatility" if v > 0.15
                else "Low Volatility")
            assert s["volatility_label"] == lab


def test_region_spread_brute_force(spark):
    data = make(5, n_series=5)
    nat_rows = [(d, "US", p) for _, d, p, *_ in make(6, n_series=1)]
    reg = spark.createDataFrame([(w, s, p, "REGULAR_GASOLINE") for s, w, p, *_ in data],
                                "week_date date, region string, price double, fuel_type string")
    nat = spark.createDataFrame(nat_rows, "week_date date, region string, regular double")
    got = {(r["region"], r["week_date"]): r.asDict()
           for r in region_spread(reg, nat, national_region="US").collect()}
    national = {d: p for d, _, p in nat_rows if p is not None}
    pdf = pd.DataFrame([(s, w, p) for s, w, p, *_ in data if p is not None],
                       columns=["region", "week_date", "price"]).sort_values(["region", "week_date"])
    for _, g in pdf.groupby("region"):
        avg4 = g.price.rolling(4, min_periods=1).mean()
        run_max = None
        for i, (_, row) in enumerate(g.iterrows()):
            s = got[(row.region, row.week_date)]
            n = national.get(row.week_date)
            spread = rnd(row.price - n) if n is not None else None
            assert s["price_spread"] == spread
            if spread is not None:
                run_max = spread if run_max is None else max(run_max, spread)
            assert s["max_spread_seen"] == run_max
            assert s["regional_4wk_avg"] == rnd(avg4.iloc[i])
