import os

import pytest
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.plans.history import read_history
from tidemark.plans.publish import read_version
from tidemark.plans.refresh import ChecksFailed, refresh_warehouse
from tidemark.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def _inputs(spark):
    nat = catalog.national(spark, SF).filter(F.col("regular").isNotNull())
    return dict(national=nat, regional=fx.regional_weekly(spark, SF),
                market=fx.market_weekly(spark, SF), crude_ticker=fx.CRUDE_TICKER)


def test_refresh_publishes_and_snapshots(spark, workdir):
    wh = os.path.join(workdir, "wh")
    v = refresh_warehouse(spark, wh, checks=catalog.suite_checks(),
                          run_ts="2026-01-05 00:00:00", **_inputs(spark))
    assert v["price_volatility"] == 0
    res = spark.read.parquet(os.path.join(wh, "check_results"))
    assert res.count() == 31 and res.filter("status = 'FAIL'").count() == 0
    final = read_version(spark, os.path.join(wh, "fuel_price_final"))
    assert final.filter("record_type = 'FORECAST'").count() == 12
    assert spark.read.parquet(os.path.join(wh, "forecast_metrics")).count() == 7
    # a second refresh with the same load times adds versions but no history rows
    v2 = refresh_warehouse(spark, wh, checks=catalog.suite_checks(),
                           run_ts="2026-01-12 00:00:00", **_inputs(spark))
    assert v2["price_volatility"] == 1
    h = read_history(spark, os.path.join(wh, "fuel_prices_history"))
    assert h.count() == 344 and h.filter("valid_to is null").count() == 344


def test_failing_check_stops_before_snapshot(spark, workdir):
    wh = os.path.join(workdir, "wh")
    inputs = _inputs(spark)
    inputs["national"] = catalog.national(spark, SF)      # one NULL regular price
    with pytest.raises(ChecksFailed):
        refresh_warehouse(spark, wh, checks=catalog.suite_checks(),
                          run_ts="2026-01-05 00:00:00", **inputs)
    assert read_history(spark, os.path.join(wh, "fuel_prices_history")) is None
