"""Lagged crude-to-retail margin (C3 - C3e)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import label_by_thresholds, round_half_away
from tidemark.functions.scope import within

# ---- fixed values -----------------------------------------------------------
MARGIN_LABELS = ("Wide Margin", "Normal Margin", "Tight Margin")
GALLONS_PER_BARREL = 42.0
# -----------------------------------------------------------------------------


def lagged_margin(retail: DataFrame, bars: DataFrame, *, ticker: str,
                  time_col: str = "week_date", retail_col: str = "regular",
                  other_cols: Sequence[str] = ("diesel",), retail_keys: Sequence[str] = (),
                  ticker_col: str = "ticker", close_col: str = "close", lag: int = 2,
                  divisor: float = GALLONS_PER_BARREL,
                  bands: tuple[float, float] = (0.80, 1.50), places: int = 4,
                  null_label: str | None = None,
                  scope: Mapping[str, str] | None = None) -> DataFrame:
    """Retail price minus the crude price of ``lag`` bars earlier, per gallon.

    * crude bars of one ticker with a close; per-gallon price = close /
      ``divisor`` rounded;
    * both forms lagged by ``lag`` rows of that ticker (a window partitioned
      by ticker, never an unpartitioned one-task window);
    * retail rows within ``scope`` (price not NULL) left-joined on equal week; unmatched weeks
      keep NULL crude columns;
    * margin = retail - coalesce(lagged, same-week) rounded; label tests the
      rounded margin; a NULL margin falls to the last label.

    The crude side holds at most one row per week of one ticker; AQE turns
    the join into a broadcast join from that side's measured size.
    """
    fuel = (within(retail, scope).filter(F.col(retail_col).isNotNull())
                  .select(time_col, *retail_keys, retail_col, *other_cols))
    crude = (bars.filter((F.col(ticker_col) == F.lit(ticker)) & F.col(close_col).isNotNull())
                 .select(ticker_col, time_col,
                         F.col(close_col).alias("crude_close_usd_bbl"),
                         round_half_away(F.col(close_col) / F.lit(divisor), places)
                         .alias("crude_usd_per_gallon")))
    w = Window.partitionBy(ticker_col).orderBy(time_col)
    lag_bbl, lag_gal = f"crude_lag{lag}_bbl", f"crude_lag{lag}_gal"
    lagged = crude.select(time_col, "crude_close_usd_bbl", "crude_usd_per_gallon",
                          F.lag("crude_close_usd_bbl", lag).over(w).alias(lag_bbl),
                          F.lag("crude_usd_per_gallon", lag).over(w).alias(lag_gal))
    joined = fuel.join(lagged, on=time_col, how="left")
    margin = round_half_away(
        F.col(retail_col) - F.coalesce(F.col(lag_gal), F.col("crude_usd_per_gallon")), places)
    low, high = bands
    label = label_by_thresholds("pump_to_crude_margin",
                                [(high, MARGIN_LABELS[0]), (low, MARGIN_LABELS[1])],
                                MARGIN_LABELS[2], null_label=null_label)
    return (joined.select(time_col, *retail_keys, retail_col, *other_cols,
                          "crude_close_usd_bbl", "crude_usd_per_gallon", lag_bbl, lag_gal,
                          margin.alias("pump_to_crude_margin"))
                  .withColumn("margin_category", label))
