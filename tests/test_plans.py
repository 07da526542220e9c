"""Plan-shape assertions: the plans we want at scale, checked on small data."""

import re

from tidemark.operators import lagged_margin, price_moving_avg, price_volatility
from tidemark.sources.shaping import weekly_bars
from tidemark.plans.upsert import keyed_upsert
from tidemark.sources import fixtures as fx
import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def many(spark):
    return fx.many_series(spark, SF).withColumnRenamed("price", "regular") \
             .withColumn("diesel", fx.F.col("regular")).withColumn("premium", fx.F.col("regular")) \
             .withColumn("midgrade", fx.F.col("regular"))


def test_volatility_windows_hash_partitioned_by_series(spark):
    p = plan(price_volatility(many(spark), series_cols="series"))
    assert "SinglePartition" not in p
    assert re.search(r"Exchange hashpartitioning\(series#\d+, \d+\)", p)
    # lag, rolling deviation and whole-series mean ride on one shuffle
    assert len(re.findall(r"Exchange hashpartitioning\(series", p)) == 1


def test_moving_avg_one_exchange_for_all_frames(spark):
    p = plan(price_moving_avg(many(spark), series_cols="series"))
    assert len(re.findall(r"Exchange hashpartitioning\(series", p)) == 1
    assert len(re.findall(r"\+- Window ", p)) == 1


def test_scan_prunes_columns(spark):
    p = plan(fx.fuel_weekly(spark, SF))
    m = re.search(r"ReadSchema: struct<([^>]*)>", p)
    assert m and sorted(f.split(":")[0] for f in m.group(1).split(",")) == [
        "o_orderdate", "o_orderpriority", "o_totalprice"]


def _bars(spark):
    # lazily all the way down to the lineitem scan (no materialized step)
    d = fx.daily_lines(spark, SF)
    daily = d.groupBy("ticker", "day").agg((fx.F.sum("s_gross") / fx.F.sum("n")).alias("p"),
                                           fx.F.sum("n").alias("n"))
    return weekly_bars(daily, key_cols=["ticker"], time_col="day", price_col="p", volume_col="n")


def test_ticker_filter_reaches_parquet(spark):
    p = plan(lagged_margin(fx.fuel_weekly(spark, SF), _bars(spark), ticker="A",
                           retail_col="all_grades"))
    assert "EqualTo(l_returnflag,A)" in p
    # the registered query's plan goes down to the fact scan, with the filter in it
    q = plan(entry.queries()["crude_lag_margin"](spark, SF))
    assert "EqualTo(l_returnflag,A)" in q


def test_accepted_values_filter_reaches_parquet_without_expand(spark):
    from tidemark.operators import checks as CK
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(CK.run_checks({"o": orders}, [CK.accepted_values("o", "o_orderstatus", ["F", "O"])]))
    assert "Expand" not in p and re.search(r"PushedFilters: \[[^]]*Not\(In\(o_orderstatus", p)


def test_ticker_overview_scans_once(spark):
    p = plan(entry.queries()["ticker_overview"](spark, SF))
    assert len(re.findall(r"FileScan parquet", p)) == 1 and "WindowGroupLimit" in p


def test_no_stale_answers(spark, workdir):
    """A rewritten input file gives new answers: nothing is kept by path."""
    import os
    import shutil
    d = os.path.join(workdir, "sf")
    os.mkdir(d)  # new files of our own: the given ones may be read-only
    for f in os.listdir(SF):
        shutil.copyfile(os.path.join(SF, f), os.path.join(d, f))
    run = entry.queries()["vol_weekly"]
    before = run(spark, d).count()
    rows = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderdate < timestamp'1996-01-01'")
    new = os.path.join(workdir, "new")
    rows.coalesce(1).write.parquet(new)
    part = next(f for f in os.listdir(new) if f.endswith(".parquet"))
    shutil.copyfile(os.path.join(new, part), os.path.join(d, "orders.parquet"))
    assert 0 < run(spark, d).count() < before


def test_upsert_broadcasts_small_batch_keys(spark):
    target = fx.fuel_weekly(spark, SF)
    batch = fx.fuel_weekly(spark, SF).filter("week_date < date'1995-03-01'")
    p = plan(keyed_upsert(target, batch, ["week_date", "region"], on_duplicate="assume_unique"))
    assert re.search(r"BroadcastHashJoin .*LeftAnti", p)


def test_partial_aggregation_before_shuffle(spark):
    p = plan(_bars(spark))
    assert "partial_sum" in p
    assert "partial_min_by" in p and "partial_max_by" in p


def test_only_fixed_dimensions_are_hinted():
    import pytest
    from tidemark.plans import joins
    with pytest.raises(ValueError):
        joins.dimension(None, "customer")


def test_customer_join_sized_by_catalyst(spark):
    # small customer files: Catalyst broadcasts the customer scan by itself
    p = plan(fx.orders_by_nation(spark, SF))
    assert re.search(r"BroadcastHashJoin \[o_custkey#\d+L\], \[c_custkey#\d+L\]", p)


def test_backtest_is_one_exchange_and_one_sort(spark):
    from tidemark.operators.metrics import backtest_drift
    df = spark.createDataFrame([], "series string, week_date date, price double")
    p = plan(backtest_drift(df))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert len(re.findall(r"\+- Sort |^Sort ", p)) == 1 and "Join" not in p
