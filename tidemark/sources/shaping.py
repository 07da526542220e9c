"""Ingest shaping (A2-A9): from landed series rows to typed raw tables.

All operators are DataFrame -> DataFrame and run on any number of series.
None of them gathers a series into one task: per-series work is either a
partial aggregation (map-side combine before the shuffle) or a window over a
series key whose rows are bounded by the number of periods.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import nan_to_null, round_half_away
from tidemark.functions.time import week_start


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# ---------------------------------------------------------------- A2 --------
def latest_per_series(df: DataFrame, series_cols, time_col: str, n: int) -> DataFrame:
    """Newest ``n`` rows of every series (the API's sort desc + length + offset 0).

    ``row_number() <= n`` over a per-series window; Spark plans this as a
    WindowGroupLimit, so each map task keeps only its local top ``n`` per
    series before the shuffle.
    """
    w = Window.partitionBy(*_cols(series_cols)).orderBy(F.col(time_col).desc())
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= n).drop("_rn"))


# ---------------------------------------------------------------- A3 --------
def select_series(df: DataFrame, id_col: str, labels: Mapping[str, str],
                  label_col: str) -> DataFrame:
    """Keep the configured series ids and attach their label.

    The id filter is an ``IN`` list (pushed to the Parquet reader); the label
    comes from a literal map, so no join is needed for this fixed dimension.
    """
    mapping = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return (df.filter(F.col(id_col).isin(list(labels)))
              .withColumn(label_col, mapping[F.col(id_col)]))


# ---------------------------------------------------------------- A4 / A5 ---
def _usable(period_col: str, value_col: str) -> Column:
    """Row rule shared by A4 and A5: skip empty/None period and None value."""
    p = F.col(period_col)
    return p.isNotNull() & (p != "") & F.col(value_col).isNotNull()


def parse_price(value_col, places: int = 4) -> Column:
    """Text -> double, rounded; anything unparseable (or NaN) gives NULL."""
    v = F.col(value_col) if isinstance(value_col, str) else value_col
    return round_half_away(v.try_cast("double"), places)


def pivot_series(long_df: DataFrame, *, period_col: str, label_col: str,
                 value_col: str, order_col: str, columns: Mapping[str, str],
                 places: int = 4) -> DataFrame:
    """Long-to-wide pivot with the national-load rules (A4).

    One row per period. For each configured label the cell holds the *last*
    parseable value in ``order_col`` order (later duplicates overwrite
    earlier ones); an unparseable value leaves the cell as it was but still
    creates the period row. ``columns`` maps label -> output column, fixing
    the value list so no extra distinct job is needed. Conditional aggregates
    in one HashAggregate: partial per map task, so a hot period or label is
    combined before the shuffle.
    """
    rows = (long_df.filter(_usable(period_col, value_col))
                   .select(F.col(period_col).alias("_period"), F.col(label_col).alias("_label"),
                           parse_price(value_col, places).alias("_v"),
                           F.col(order_col).alias("_ord")))
    aggs = []
    for label, out in columns.items():
        hit = (F.col("_label") == F.lit(label)) & F.col("_v").isNotNull()
        aggs.append(F.max_by(F.when(hit, F.col("_v")), F.when(hit, F.col("_ord"))).alias(out))
    return rows.groupBy(F.col("_period").alias(period_col)).agg(*aggs)


def flatten_series(long_df: DataFrame, *, period_col: str, value_col: str,
                   keep_cols: Sequence[str] = (), places: int = 4,
                   out_col: str = "price") -> DataFrame:
    """Regional flatten (A5): same skip rule, unparseable value drops the row.

    No de-duplication (the regional load keeps every row).
    """
    return (long_df.filter(_usable(period_col, value_col))
                   .select(*keep_cols, F.col(period_col),
                           parse_price(value_col, places).alias(out_col))
                   .filter(F.col(out_col).isNotNull()))


# ---------------------------------------------------------------- A6 / A9 ---
def clean_bars(bars: DataFrame, *, time_col: str = "week_date",
               price_cols: Sequence[str] = ("open", "high", "low", "close"),
               close_col: str = "close", volume_col: str = "volume",
               places: int = 4) -> DataFrame:
    """OHLCV clean (A6): drop a bar whose close is NaN/NULL; NaN in the other
    prices or volume becomes NULL; prices round to ``places``; volume is
    truncated to a whole number; the time becomes a DATE.
    """
    close = F.col(close_col)
    kept = bars.filter(close.isNotNull() & ~F.isnan(close))
    out = kept.withColumn(time_col, F.to_date(F.col(time_col)))
    for c in price_cols:
        out = out.withColumn(c, round_half_away(nan_to_null(F.col(c).cast("double")), places))
    vol = nan_to_null(F.col(volume_col).cast("double"))
    return out.withColumn(volume_col, vol.try_cast("long"))


def conform(df: DataFrame, schema, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Column reorder / rename / cast to a table schema (A9, B1 typed stage)."""
    renames = dict(renames or {})
    have = set(df.columns)
    cols = []
    for field in schema.fields:
        src = next((k for k, v in renames.items() if v == field.name), field.name)
        if src in have:
            cols.append(F.col(src).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


# ---------------------------------------------------------------- A7 --------
def weekly_bars(ticks: DataFrame, *, key_cols, time_col: str, price_col: str,
                volume_col: str | None = None, places: int | None = 4,
                out_time_col: str = "week_date") -> DataFrame:
    """Daily (or tick) prices to weekly OHLCV bars.

    open / close are the price at the earliest / latest time of the week
    (``min_by`` / ``max_by``), high / low the extremes, volume the sum; NULL and
    NaN prices and volumes are left out.
    Times must be distinct within a key and week for open / close to be
    deterministic. One partial + final aggregation: a key holding a third of
    all rows is combined map-side to one row per week and task.
    """
    keys = _cols(key_cols)
    # Bad ticks go before the week is formed: one NaN must not spoil a bar.
    p, t = nan_to_null(F.col(price_col).cast("double")), F.col(time_col)
    at = F.when(p.isNotNull(), t)
    rnd = (lambda c: round_half_away(c, places)) if places is not None else (lambda c: c)
    aggs = [rnd(F.min_by(p, at)).alias("open"), rnd(F.max(p)).alias("high"),
            rnd(F.min(p)).alias("low"), rnd(F.max_by(p, at)).alias("close")]
    if volume_col is not None:
        volume = nan_to_null(F.col(volume_col).cast("double"))
        aggs.append(F.sum(volume).try_cast("long").alias("volume"))
    return ticks.groupBy(week_start(t).alias(out_time_col), *keys).agg(*aggs)


# ---------------------------------------------------------------- A8 --------
def trailing_window(df: DataFrame, *, time_col: str, months: int = 48,
                    as_of=None) -> DataFrame:
    """Rows within ``months`` before ``as_of`` (default: newest date in ``df``).

    The default ``as_of`` is a scalar subquery: Spark runs it as its own small
    aggregation job and plugs the value into the filter, so no join and no
    single-task window is needed.
    """
    if as_of is None:
        anchor = df.select(F.max(time_col)).scalar()
    else:
        anchor = F.lit(as_of).cast("date")
    return df.filter(F.col(time_col) >= F.add_months(anchor, -months))
