"""One refresh of the published tables: models -> checks -> history -> forecast.

Order and stop rule follow the reference's flow: the four models are rebuilt
in full, then the checks run on what was published, a failing check stops
the run before the history snapshot, and the forecast step writes the
forecast, the history+forecast table and appends the metrics.

Each table is published as a new version (see :mod:`tidemark.plans.publish`),
so readers never see a half-written refresh, and checks read the published
files instead of recomputing the models.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks as CK
from tidemark.operators import forecast as FC
from tidemark.operators import metrics as MT
from tidemark.operators.margin import lagged_margin
from tidemark.operators.moving_avg import price_moving_avg
from tidemark.operators.region_spread import region_spread
from tidemark.operators.volatility import price_volatility
from tidemark.plans import history as H
from tidemark.plans.publish import append_run, publish, read_version
from tidemark.schemas import FINAL, FORECAST, METRICS, NATIONAL_KEY
from tidemark.sources.shaping import conform


#: What the published models are ordered by.
MODEL_ORDER = {"price_moving_avg": ("week_date",), "price_volatility": ("week_date",),
               "crude_correlation": ("week_date",),
               "regional_comparison": ("week_date", "region")}


class ChecksFailed(RuntimeError):
    def __init__(self, failed: list):
        super().__init__(f"{len(failed)} check(s) failed: {failed}")
        self.failed = failed


def build_models(national: DataFrame, regional: DataFrame, market: DataFrame, *,
                 crude_ticker: str, series_col: str = "region",
                 scope: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The four models over the raw tables (lazy DataFrames); the first three are
    about the national rows that ``scope`` names."""
    return {
        "price_moving_avg": price_moving_avg(national, series_cols=series_col, scope=scope),
        "price_volatility": price_volatility(national, series_cols=series_col, scope=scope),
        "crude_correlation": lagged_margin(national, market, ticker=crude_ticker, scope=scope),
        "regional_comparison": region_spread(regional, national),
    }


def refresh_warehouse(spark: SparkSession, warehouse: str, *, national: DataFrame,
                      regional: DataFrame, market: DataFrame, crude_ticker: str,
                      checks: Sequence[CK.Check], run_ts: str, strict: bool = True,
                      horizon: int = 12, level: float = 0.95,
                      publish_raw: bool = True,
                      scope: Mapping[str, str] | None = None) -> Mapping[str, int]:
    """Run one refresh; returns the published version of every table.

    ``publish_raw=False`` takes the three raw tables as already stored (kept
    by the keyed loads) instead of writing a copy into the warehouse.
    """
    root = warehouse.rstrip("/")
    versions: dict[str, int] = {}
    raw = {"fuel_prices": national, "regional_fuel_prices": regional,
           "energy_market_prices": market}
    if publish_raw:
        for name, df in raw.items():
            versions[name] = publish(df, f"{root}/{name}")
        pub = {name: read_version(spark, f"{root}/{name}") for name in raw}
    else:
        pub = dict(raw)
    models = build_models(pub["fuel_prices"], pub["regional_fuel_prices"],
                          pub["energy_market_prices"], crude_ticker=crude_ticker, scope=scope)
    for name, df in models.items():
        versions[name] = publish(df, f"{root}/{name}", order_by=MODEL_ORDER[name])
        pub[name] = read_version(spark, f"{root}/{name}")

    report = CK.run_checks(pub, checks).withColumn("run_ts", F.lit(run_ts).cast("timestamp_ntz"))
    append_run(report, f"{root}/check_results", run_ts)
    # a bounded read: one row per configured check
    failed = [(r["table_name"], r["column_name"], r["test_name"], r["failures"])
              for r in report.filter(F.col("status") == "FAIL").collect()]
    if failed and strict:
        raise ChecksFailed(failed)

    # History: only open versions are read and rewritten; closed ones are
    # appended once per run (see plans.history.snapshot_table).
    H.snapshot_table(spark, f"{root}/fuel_prices_history", pub["fuel_prices"], NATIONAL_KEY,
                     run_ts=run_ts)

    train = FC.training_set(pub["fuel_prices"], series_col="region", time_col="week_date",
                            target_col="regular", scope=scope)
    fc = FC.forecast_drift(train, series_col="region", horizon=horizon, level=level)
    versions["fuel_price_forecast"] = publish(conform(fc, FORECAST), f"{root}/fuel_price_forecast")
    fc_pub = read_version(spark, f"{root}/fuel_price_forecast")
    final = FC.history_plus_forecast(pub["fuel_prices"], fc_pub, scope=scope)
    versions["fuel_price_final"] = publish(conform(final, FINAL), f"{root}/fuel_price_final")
    bt = MT.backtest_drift(train, series_col="region", target_col="regular",
                           horizon=horizon, level=level)
    append_run(conform(MT.error_metrics(bt, series_col="region", run_ts=run_ts), METRICS),
               f"{root}/forecast_metrics", run_ts, schema=METRICS)
    skipped = FC.skip_reasons(pub["fuel_prices"], fc_pub, series_col="region",
                              target_col="regular")
    versions["fuel_price_skipped"] = publish(skipped, f"{root}/fuel_price_skipped")
    return versions
