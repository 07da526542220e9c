"""tidemark: weekly price analytics as plain Spark DataFrame functions.

    from tidemark import price_volatility, keyed_upsert, snapshot
    vol = price_volatility(national_df, series_cols="region")
"""

from tidemark.operators.checks import Check, accepted_values, not_null, run_checks
from tidemark.operators.forecast import (
    forecast_drift,
    forecast_pooled,
    forecast_trend,
    history_plus_forecast,
    training_set,
)
from tidemark.operators.margin import lagged_margin
from tidemark.operators.metrics import backtest_drift, error_metrics
from tidemark.operators.moving_avg import price_moving_avg
from tidemark.operators.region_spread import region_spread
from tidemark.operators.volatility import price_volatility
from tidemark.plans.history import as_of, current_rows, snapshot, with_current_flag
from tidemark.plans.publish import load, publish, read_version
from tidemark.plans.refresh import refresh_warehouse
from tidemark.plans.upsert import keyed_upsert, stage
from tidemark.session import build_session, tune
from tidemark.sources.payload import explode_payload, parse_payload_text, read_payload_files
from tidemark.sources.shaping import (
    clean_bars,
    conform,
    flatten_series,
    latest_per_series,
    pivot_series,
    select_series,
    trailing_window,
    weekly_bars,
)

__version__ = "0.1.0"

__all__ = [
    "Check", "accepted_values", "not_null", "run_checks",
    "forecast_drift", "forecast_pooled", "forecast_trend", "history_plus_forecast",
    "training_set", "lagged_margin", "backtest_drift", "error_metrics",
    "price_moving_avg", "region_spread", "price_volatility",
    "as_of", "current_rows", "snapshot", "with_current_flag",
    "load", "publish", "read_version", "refresh_warehouse", "keyed_upsert", "stage",
    "build_session", "tune", "explode_payload", "parse_payload_text", "read_payload_files",
    "clean_bars", "conform", "flatten_series", "latest_per_series", "pivot_series",
    "select_series", "trailing_window", "weekly_bars",
]
