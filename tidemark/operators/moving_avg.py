"""Rolling averages and grade spreads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away
from tidemark.functions.scope import within


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def price_moving_avg(df: DataFrame, *, series_cols="region", time_col: str = "week_date",
                     filter_col: str = "regular",
                     price_cols: Sequence[str] = ("regular", "diesel"),
                     windows: Sequence[int] = (4, 12, 52),
                     spreads: Sequence[tuple[str, str, str]] = (
                         ("premium_spread", "premium", "regular"),
                         ("diesel_spread", "diesel", "regular")),
                     passthrough: Sequence[str] = ("midgrade", "premium"),
                     places: int = 4, scope: Mapping[str, str] | None = None) -> DataFrame:
    """Trailing means over the last ``n`` rows of each series, plus spreads.
    ``scope`` keeps one series out of several (see :func:`within`).

    Rows with NULL ``filter_col`` are removed first, so frames count rows, not
    calendar weeks. Partial frames at the start still give a value; NULLs
    inside a frame are ignored by the mean. All frames share one partition
    and order, so the plan has a single Exchange + Sort feeding one Window.
    Rows per series are bounded by the number of weeks (unique series/week).
    """
    keys = _cols(series_cols)
    base = within(df, scope).filter(F.col(filter_col).isNotNull())
    w = Window.partitionBy(*keys).orderBy(time_col)
    out = []
    for n in windows:
        frame = w.rowsBetween(-(n - 1), Window.currentRow)
        for c in price_cols:
            out.append(round_half_away(F.avg(c).over(frame), places).alias(f"{c}_{n}wk_avg"))
    spread_cols = [round_half_away(F.col(a) - F.col(b), places).alias(name)
                   for name, a, b in spreads]
    kept = [c for c in (*price_cols, *passthrough) if c in df.columns]
    kept = list(dict.fromkeys(kept))
    return base.select(time_col, *keys, *kept, *out, *spread_cols)
