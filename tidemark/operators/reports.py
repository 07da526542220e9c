"""Reporting queries behind the dashboards.

Each report is a grouped aggregation over a model table. Inputs hold one row
per (series, week), so per-group work is bounded by the number of weeks; the
reports themselves are a handful of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away
from tidemark.plans.ordering import exact_quantiles, ranked
from tidemark.session import staged


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """row count of each published table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_by(df: DataFrame, col: str) -> DataFrame:
    """rows per value (e.g. per ticker), in order of the value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("row_count")).orderBy(col)


def latest_value(df: DataFrame, *, series_col: str, time_col: str, value_col: str) -> DataFrame:
    """newest non-NULL value of every series (gauge)."""
    v = F.col(value_col)
    return (df.filter(v.isNotNull()).groupBy(series_col)
              .agg(F.max(time_col).alias("latest_week"),
                   F.max_by(v, F.col(time_col)).alias("latest_value")))


def forecast_card(final: DataFrame, *, step: str = "last") -> DataFrame:
    """one future point per series from the history+forecast table."""
    fc = final.filter(F.col("record_type") == F.lit("FORECAST"))
    pick = F.max_by if step == "last" else F.min_by
    t = F.col("week_date")
    return fc.groupBy("region").agg(
        (F.max(t) if step == "last" else F.min(t)).alias("week_date"),
        pick(F.col("forecast"), t).alias("forecast"),
        pick(F.col("lower_bound"), t).alias("lower_bound"),
        pick(F.col("upper_bound"), t).alias("upper_bound"))


def relation_stats(df: DataFrame, *, x: str, y: str, places: int = 4,
                   group_cols=()) -> DataFrame:
    """direction and strength of a relation (scatter summary)."""
    return df.groupBy(*group_cols).agg(
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.lit(1))).alias("n_pairs"),
        round_half_away(F.corr(y, x), places).alias("correlation"),
        round_half_away(F.regr_slope(y, x), places).alias("slope"),
        round_half_away(F.regr_intercept(y, x), places).alias("intercept"))


def region_ranking(cmp: DataFrame, *, region_col: str = "region",
                   pct_col: str = "price_spread_pct", places: int = 4) -> DataFrame:
    """mean / min / max percent spread per region, ranked by the mean.

    The rank runs over the already-aggregated rows (one per region).
    """
    g = cmp.groupBy(region_col).agg(
        round_half_away(F.avg(pct_col), places).alias("avg_spread_pct"),
        F.min(pct_col).alias("min_spread_pct"), F.max(pct_col).alias("max_spread_pct"),
        F.count(F.col(pct_col)).alias("n_weeks"))
    return g.withColumn("spread_rank", F.rank().over(Window.orderBy(F.desc("avg_spread_pct"))))


def box_stats(df: DataFrame, *, group_col: str, value_col: str, places: int = 4,
              exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """F8: quartiles, range, 1.5 IQR fences and outlier count per group.

    ``exact=True`` (default) interpolates linearly between order statistics;
    its per-group buffer holds the group's values, which is bounded here
    because a group has one row per week. For groups that grow with the
    data use ``exact=False``: ``percentile_approx`` keeps a fixed-size sketch
    per group and merges sketches map-side.
    """
    v = F.col(value_col)
    if exact:
        pct = lambda p: F.percentile(v, p)
    else:
        pct = lambda p: F.percentile_approx(v, p, accuracy).cast("double")
    q = (df.filter(v.isNotNull()).groupBy(group_col)
           .agg(pct(0.25).alias("q1"), pct(0.5).alias("median"),
                pct(0.75).alias("q3"), F.min(v).alias("min_value"),
                F.max(v).alias("max_value"), F.count(v).alias("n")))
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_fence", F.col("q1") - F.lit(1.5) * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * F.col("iqr")))
    outl = (df.join(q.select(group_col, "lower_fence", "upper_fence"), on=group_col)
              .groupBy(group_col)
              .agg(F.count_if((v < F.col("lower_fence")) | (v > F.col("upper_fence")))
                   .alias("n_outliers")))
    return q.join(outl, on=group_col).select(
        group_col, "n", *[round_half_away(c, places).alias(c) for c in
                          ("min_value", "q1", "median", "q3", "max_value", "iqr",
                           "lower_fence", "upper_fence")],
        "n_outliers")


def box_stats_unbounded(df: DataFrame, *, group_col: str, value_col: str,
                        places: int = 4) -> DataFrame:
    """F8 for groups that grow with the data: the same exact figures as :func:`box_stats`,
    from ranks over range partitions instead of a buffer per group. The input is read
    once; outliers are counted from the counts of distinct values."""
    q, counted = exact_quantiles(df, group_col, value_col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_fence", F.col("q1") - F.lit(1.5) * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * F.col("iqr")))
    v, fences = F.col(value_col), q.select(F.col(group_col).alias("_g"), "lower_fence", "upper_fence")
    outside = F.when((v < F.col("lower_fence")) | (v > F.col("upper_fence")), F.col("times"))
    outl = (counted.join(fences, F.col(group_col).eqNullSafe(F.col("_g"))).groupBy("_g")
            .agg(F.coalesce(F.sum(outside), F.lit(0)).alias("n_outliers")))
    return q.join(outl, F.col(group_col).eqNullSafe(F.col("_g"))).select(
        group_col, "n", *[round_half_away(c, places).alias(c) for c in
                          ("min_value", "q1", "median", "q3", "max_value", "iqr",
                           "lower_fence", "upper_fence")],
        "n_outliers")


def series_ranking(cmp: DataFrame, *, region_col: str = "region",
                   pct_col: str = "price_spread_pct", places: int = 4) -> DataFrame:
    """F7 for any number of series: :func:`region_ranking` without a one-task window."""
    g = cmp.groupBy(region_col).agg(
        round_half_away(F.avg(pct_col), places).alias("avg_spread_pct"),
        F.min(pct_col).alias("min_spread_pct"), F.max(pct_col).alias("max_spread_pct"),
        F.count(F.col(pct_col)).alias("n_weeks"))
    # Written once: the ranges and the rows that get their ranks are the same values.
    g, _ = staged(g, "ranking")
    return ranked(g, "avg_spread_pct", name="spread_rank")


def label_share(df: DataFrame, *, label_col: str, places: int = 2) -> DataFrame:
    """percent of rows per label. The total is a scalar subquery."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_weeks"))
              .withColumn("pct_weeks",
                          round_half_away(F.col("n_weeks") * F.lit(100.0) / total, places)))


def ticker_overview(bars: DataFrame, *, ticker_col: str = "ticker",
                    time_col: str = "week_date", places: int = 2) -> DataFrame:
    """newest bar per ticker with its change from the bar before.

    The two newest rows of each ticker (Spark keeps two per task and ticker
    before the shuffle), then one lag over them: a single scan.
    """
    newest = Window.partitionBy(ticker_col).orderBy(F.col(time_col).desc())
    prev = F.lead("close", 1).over(newest)
    two = bars.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= 2)
    out = (two.select(ticker_col, time_col, "open", "high", "low", "close", "volume",
                      prev.alias("prev_close"), "_rn").filter(F.col("_rn") == 1).drop("_rn"))
    return out.select(
        "*", round_half_away(F.col("close") - F.col("prev_close"), 4).alias("change"),
        F.when(F.col("prev_close") > 0,
               round_half_away((F.col("close") - F.col("prev_close")) / F.col("prev_close")
                               * 100, places)).alias("change_pct"))
