"""Week-over-week change, rolling deviation and labels (C2 - C2e)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import guarded_pct_change, label_by_thresholds, round_half_away
from tidemark.functions.scope import within

# ---- fixed values -----------------------------------------------------------
DIRECTION_LABELS = ("Rising", "Falling", "Stable")
VOLATILITY_LABELS = ("High Volatility", "Moderate Volatility", "Low Volatility")
# -----------------------------------------------------------------------------


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def price_volatility(df: DataFrame, *, series_cols="region", time_col: str = "week_date",
                     price_col: str = "regular", other_cols: Sequence[str] = ("diesel",),
                     window: int = 12, move: float = 0.05,
                     bands: tuple[float, float] = (0.15, 0.30), places: int = 4,
                     null_direction: str | None = None,
                     null_volatility: str | None = None,
                     scope: Mapping[str, str] | None = None) -> DataFrame:
    """Volatility model for any number of series (or those within ``scope``).

    * change = price - previous row's price (``lag 1``, rows after the NULL
      filter), rounded; percent change only when the previous price > 0;
    * historical mean over the whole series (shown rounded) and anomaly =
      price - unrounded mean;
    * sample deviation over the last ``window`` rows (NULL on the first row);
    * direction tests the *rounded* change against +-``move``; volatility the
      *unrounded* deviation against ``bands``; NULL goes to the last label.

    One Exchange on the series key; lag, rolling deviation and the
    whole-series mean are evaluated by Window nodes over that one shuffle.
    """
    keys = _cols(series_cols)
    p = F.col(price_col)
    base = within(df, scope).filter(p.isNotNull())
    ordered = Window.partitionBy(*keys).orderBy(time_col)
    whole = Window.partitionBy(*keys)
    frame = ordered.rowsBetween(-(window - 1), Window.currentRow)

    prev = {c: F.lag(c, 1).over(ordered) for c in (price_col, *other_cols)}
    staged = base.select(
        time_col, *keys, price_col, *other_cols,
        *[prev[c].alias(f"_prev_{c}") for c in (price_col, *other_cols)],
        F.avg(price_col).over(whole).alias("_hist"),
        F.stddev_samp(price_col).over(frame).alias("_sd"),
    )
    change = {c: round_half_away(F.col(c) - F.col(f"_prev_{c}"), places)
              for c in (price_col, *other_cols)}
    low, high = bands
    lo_dir = -move
    direction = F.when(F.col(f"{price_col}_wow_change") > F.lit(move), F.lit(DIRECTION_LABELS[0])) \
                 .when(F.col(f"{price_col}_wow_change") < F.lit(lo_dir), F.lit(DIRECTION_LABELS[1])) \
                 .otherwise(F.lit(DIRECTION_LABELS[2]))
    if null_direction is not None:
        direction = F.when(F.col(f"{price_col}_wow_change").isNull(),
                           F.lit(null_direction)).otherwise(direction)
    vol_label = label_by_thresholds("_sd", [(high, VOLATILITY_LABELS[0]),
                                            (low, VOLATILITY_LABELS[1])],
                                    VOLATILITY_LABELS[2], null_label=null_volatility)
    with_changes = staged.select(
        "*", *[change[c].alias(f"{c}_wow_change") for c in (price_col, *other_cols)])
    return with_changes.select(
        time_col, *keys, price_col, *other_cols,
        *[f"{c}_wow_change" for c in (price_col, *other_cols)],
        guarded_pct_change(price_col, f"_prev_{price_col}", places).alias(
            f"{price_col}_wow_pct_change"),
        round_half_away("_hist", places).alias(f"hist_avg_{price_col}"),
        round_half_away(p - F.col("_hist"), places).alias("price_anomaly"),
        round_half_away("_sd", places).alias(f"rolling_{window}wk_stddev"),
        direction.alias("price_direction"),
        vol_label.alias("volatility_label"),
    )
