"""Registered queries: Spark implementation + DuckDB oracle text.

Every query reads whole driver tables (through the weekly fixture tables of
:mod:`tidemark.sources.fixtures`), so its work grows with the data. The SQL
twins build the same fixture tables as CTEs and then state each operator in
plain SQL; column names match the Spark output one to one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import catalog_forecast as CF
from tidemark import oracle as O
from tidemark.functions.numeric import round_half_away
from tidemark.functions.time import week_start
from tidemark.operators import checks as CK
from tidemark.operators import forecast as FC
from tidemark.operators import metrics as MT
from tidemark.operators import reports as RP
from tidemark.operators.margin import lagged_margin
from tidemark.operators.moving_avg import price_moving_avg
from tidemark.operators.region_spread import CATEGORY_LABELS, region_spread
from tidemark.operators.volatility import DIRECTION_LABELS, VOLATILITY_LABELS, price_volatility
from tidemark.operators.margin import MARGIN_LABELS
from tidemark.plans import history as H
from tidemark.plans.joins import dimension
from tidemark.plans.ordering import chunked, read_in_order, write_ordered
from tidemark.plans.publish import append_run, publish, read_version, replace_view
from tidemark.plans.upsert import keyed_upsert, stage
from tidemark.schemas import MARKET, MARKET_KEY, NATIONAL, NATIONAL_KEY, REGIONAL, REGIONAL_KEY
from tidemark.sources import fixtures as fx
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.payload import (
    build_payload_pages,
    explode_payload,
    parse_payload_text,
    parse_points,
    payload_rejects,
    read_payload_files,
)
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
from tidemark.sources.tables import read_table

R, WEEK, q = O.R, O.WEEK, O._q

# ---- fixed values of the registered scenarios -------------------------------
RUN_TS = "2026-01-12 00:00:00"        # second load (upserts, snapshot run 2)
AS_OF = "2026-01-08 00:00:00"         # as-of read between the two runs
REVISION_SCALE = 10000.0              # lineitem prices -> revised weekly prices
REVISION_FLAGS = {"regular": "N", "midgrade": "R", "premium": "A"}
REVISION_DIESEL_STATUS = "O"
HORIZON = 12
LEVEL = 0.95
RETENTION_MONTHS = 48
LATEST_REGIONAL = 104
LATEST_NATIONAL = 200
EVENT_CHUNK = 500                     # rows of a series that one task window sees
WITHDRAWN_DAY = 15                    # weeks that begin on this day leave the source
# event type -> grade column, for the series-selection + pivot scenario
EVENT_GRADES = {"view": "regular", "click": "midgrade", "purchase": "premium", "signup": "diesel"}
# -----------------------------------------------------------------------------

Z = FC.z_value(LEVEL)
ZSQL = f"cast({Z!r} AS double)"
RUN_TS_SQL = f"cast({q(RUN_TS)} AS timestamp)"
NAT_COLS = [f.name for f in NATIONAL.fields]
REG_COLS = [f.name for f in REGIONAL.fields]
MKT_COLS = [f.name for f in MARKET.fields]


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# =============================================================== Spark side ==
def national(spark, d) -> DataFrame:
    return fx.fuel_weekly(spark, d).select(*NAT_COLS)


def revised_national(spark, d) -> DataFrame:
    """Second load of the national table: weekly prices from lineitem
    (re-aggregated from the shared daily lineitem table)."""
    daily = fx.daily_lines(spark, d)

    def mean_where(cond):
        return (F.sum(F.when(cond, F.col("s_gross"))).cast("double")
                / F.sum(F.when(cond, F.col("n"))) / F.lit(REVISION_SCALE))

    grades = [round_half_away(mean_where(F.col("ticker") == F.lit(f)), 4).alias(g)
              for g, f in REVISION_FLAGS.items()]
    diesel = round_half_away(mean_where(F.col("status") == F.lit(REVISION_DIESEL_STATUS)),
                             4).alias("diesel")
    return (daily.groupBy(week_start("day").alias("week_date")).agg(*grades, diesel)
                 .select("week_date", F.lit(fx.NATIONAL_REGION).alias("region"),
                         "regular", "midgrade", "premium", "diesel",
                         F.lit(fx.PRICE_UNIT).alias("price_unit"),
                         F.lit(fx.NATIONAL_SOURCE).alias("source"), _ts(RUN_TS).alias("load_ts")))


def revised_regional(spark, d) -> DataFrame:
    """Second load of the regional table: lineitem prices by supplier region,
    newest 104 weeks of each.

    lineitem joins the supplier scan (Catalyst sizes it from the supplier
    files; beyond the threshold a shuffle join whose hot supplier partitions
    AQE splits) and the fixed 25-row nation -> region map.
    """
    li = read_table(spark, d, "lineitem", ["l_suppkey", "l_shipdate", "l_extendedprice"])
    sup = read_table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    n = read_table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    dim = (n.join(dimension(r, "region"), n.n_regionkey == r.r_regionkey)
            .select("n_nationkey", "r_name"))
    g = (li.join(sup, li.l_suppkey == sup.s_suppkey)
           .join(dimension(dim, "nation"), sup.s_nationkey == dim.n_nationkey)
           .groupBy(week_start("l_shipdate").alias("week_date"), F.col("r_name").alias("region"))
           .agg(F.sum(fx.cents("l_extendedprice")).cast("double").alias("s"),
                F.count(F.lit(1)).alias("n")))
    g = latest_per_series(g, "region", "week_date", LATEST_REGIONAL)
    return g.select("week_date", "region",
                    round_half_away(F.col("s") / F.col("n") / F.lit(REVISION_SCALE), 4).alias("price"),
                    F.lit(fx.FUEL_TYPE).alias("fuel_type"), F.lit(fx.PRICE_UNIT).alias("price_unit"),
                    F.lit(fx.REGIONAL_SOURCE).alias("source"), _ts(RUN_TS).alias("load_ts"))


def revised_market(spark, d) -> DataFrame:
    """Second load of the market table: net-price bars of the last four years."""
    bars = weekly_bars(fx.daily_ticks(spark, d), key_cols=["ticker"], time_col="day",
                       price_col="p_net", volume_col="n")
    bars = trailing_window(bars, time_col="week_date", months=RETENTION_MONTHS)
    return bars.select("week_date", "ticker", fx.ticker_name_col().alias("ticker_name"),
                       "open", "high", "low", "close", "volume", _ts(RUN_TS).alias("load_ts"))


def upserted_national(spark, d) -> DataFrame:
    """The weekly national load: newest 200 revised weeks merged into the table."""
    batch = latest_per_series(revised_national(spark, d), "region", "week_date", LATEST_NATIONAL)
    return keyed_upsert(national(spark, d), batch, NATIONAL_KEY, run_ts=RUN_TS,
                        on_duplicate="assume_unique")


def vol_model(spark, d, price="all_grades") -> DataFrame:
    return price_volatility(fx.fuel_weekly(spark, d), series_cols="region", price_col=price,
                            other_cols=("diesel",))


def ma_model(spark, d) -> DataFrame:
    return price_moving_avg(fx.fuel_weekly(spark, d), series_cols="region")


def crude_model(spark, d, price="all_grades") -> DataFrame:
    return lagged_margin(fx.fuel_weekly(spark, d), fx.market_weekly(spark, d),
                         ticker=fx.CRUDE_TICKER, retail_col=price, other_cols=("diesel",))


def regional_model(spark, d) -> DataFrame:
    return region_spread(fx.regional_weekly(spark, d), fx.fuel_weekly(spark, d),
                         national_price="regular")


def many_model(spark, d) -> DataFrame:
    """Every nation and order priority against the national series."""
    return region_spread(fx.many_series(spark, d), fx.fuel_weekly(spark, d), region_col="series",
                         fuel_type=None)


def long_series(spark, d) -> DataFrame:
    """Rolling figures of the raw events, one series a type: as long as the table is."""
    events = read_table(spark, d, "events", ["event_id", "event_type", "ts", "value"])
    out = chunked(
        events, ["event_type"], "ts", rows_before=51, chunk=EVENT_CHUNK,
        windows={"mean_52": lambda w: F.avg("value").over(w.rowsBetween(-51, 0)),
                 "sd_12": lambda w: F.stddev_samp("value").over(w.rowsBetween(-11, 0)),
                 "change": lambda w: F.col("value") - F.lag("value", 1).over(w)},
        running={"highest": ("max", "value")})
    return out.select("event_id", "event_type", "value", *(
        round_half_away(c, 4).alias(c) for c in ("mean_52", "sd_12", "change", "highest")))


def spread_in_order(spark, d) -> DataFrame:
    """The regional model as ordered files, and each row's place in them."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ordered/{uuid.uuid4().hex}"
    write_ordered(regional_model(spark, d), path, ["week_date", "region"])
    return read_in_order(spark, path).select("row_no", "week_date", "region", "price_spread")


def national_forecast(spark, d) -> DataFrame:
    train = FC.training_set(fx.fuel_weekly(spark, d), series_col="region",
                            time_col="week_date", target_col="regular")
    return FC.forecast_drift(train, series_col="region", horizon=HORIZON, level=LEVEL)


def final_table(spark, d) -> DataFrame:
    return FC.history_plus_forecast(fx.fuel_weekly(spark, d), national_forecast(spark, d))


def payload_points(spark, d) -> DataFrame:
    pages = parse_payload_text(fx.payload_pages(spark, d), "body", on_error="fail")
    return explode_payload(pages, keep_cols=["series", "page"])


def history_runs(spark, d) -> DataFrame:
    h1 = H.initial_history(national(spark, d), NATIONAL_KEY)
    # The source lost some weeks between the runs: these are closed as deleted.
    src2 = upserted_national(spark, d).filter(F.dayofmonth("week_date") != WITHDRAWN_DAY)
    return H.snapshot(h1, src2, NATIONAL_KEY, run_ts=RUN_TS)


def published_tables(spark, d) -> dict[str, DataFrame]:
    return {
        "fuel_prices": national(spark, d),
        "regional_fuel_prices": fx.regional_weekly(spark, d),
        "energy_market_prices": fx.market_weekly(spark, d),
        "price_moving_avg": ma_model(spark, d),
        "price_volatility": vol_model(spark, d, "regular"),
        "crude_correlation": crude_model(spark, d, "regular"),
        "regional_comparison": regional_model(spark, d),
    }


def suite_checks() -> list[CK.Check]:
    """The 31 checks, expressed over the fixture domains (regions = customer
    regions, tickers = return flags)."""
    regions = sorted(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])
    return [
        *CK.not_null("fuel_prices", "week_date", "region", "regular"),
        CK.accepted_values("fuel_prices", "region", [fx.NATIONAL_REGION]),
        CK.accepted_values("fuel_prices", "source", [fx.NATIONAL_SOURCE]),
        *CK.not_null("regional_fuel_prices", "week_date", "region", "price"),
        CK.accepted_values("regional_fuel_prices", "region", regions),
        CK.accepted_values("regional_fuel_prices", "fuel_type", [fx.FUEL_TYPE]),
        *CK.not_null("energy_market_prices", "week_date", "ticker", "close"),
        CK.accepted_values("energy_market_prices", "ticker", list(fx.TICKER_NAMES)),
        *CK.not_null("price_moving_avg", "week_date", "region", "regular",
                     "regular_4wk_avg", "regular_12wk_avg"),
        *CK.not_null("price_volatility", "week_date", "region", "regular"),
        CK.accepted_values("price_volatility", "price_direction", DIRECTION_LABELS),
        CK.accepted_values("price_volatility", "volatility_label", VOLATILITY_LABELS),
        *CK.not_null("crude_correlation", "week_date", "regular"),
        CK.accepted_values("crude_correlation", "margin_category", MARGIN_LABELS),
        *CK.not_null("regional_comparison", "week_date", "region", "regional_price"),
        CK.accepted_values("regional_comparison", "price_category", CATEGORY_LABELS),
    ]


def _checks(spark, d, test=None) -> DataFrame:
    chs = [c for c in suite_checks() if test is None or c.test == test]
    tables = published_tables(spark, d)
    return CK.run_checks({t: tables[t] for t in {c.table for c in chs}}, chs)


def _market_raw_bars(spark, d) -> DataFrame:
    return weekly_bars(fx.daily_ticks(spark, d), key_cols=["ticker"], time_col="day",
                       price_col="p", volume_col="n", places=None)


def _vol_many(s, d) -> DataFrame:
    return price_volatility(fx.many_series(s, d), series_cols="series", price_col="price",
                            other_cols=())


def _ma_many(s, d) -> DataFrame:
    return price_moving_avg(fx.many_series(s, d), series_cols="series", filter_col="price",
                            price_cols=("price",), spreads=(), passthrough=())


def _pivot(s, d) -> DataFrame:
    # One number for the order in the documents: the aggregate stays a hash aggregate.
    pts = payload_points(s, d).withColumn("_ord", F.col("page") * (1 << 32) + F.col("pos"))
    picked = select_series(pts, "series", EVENT_GRADES, "grade")
    wide = pivot_series(picked, period_col="period", label_col="grade", value_col="value",
                        order_col="_ord", columns={g: g for g in EVENT_GRADES.values()})
    return wide.withColumn("period", F.col("period").try_cast("date"))


SCOPE = {"region": fx.NATIONAL_REGION}
GRADES = ["regular", "midgrade", "premium", "diesel"]


def _payload_files(s, d) -> DataFrame:
    """Land real payload files, some of them broken, read them back tolerantly:
    points and rejected documents per series."""
    pts = fx.points_dirty(s, d).withColumn("page", F.floor(F.col("event_id") / fx.PAYLOAD_PAGE))
    pages = build_payload_pages(pts, series_col="series", page_col="page", order_col="event_id")
    broken = F.col("page") % 7 == 0
    body = F.when(broken, F.expr("left(body, length(body) - 3)")).otherwise(F.col("body"))
    root = f"{ensure_checkpoint_dir(s).rstrip('/')}/landing/{uuid.uuid4().hex}"
    pages.select("series", body.alias("value")).write.partitionBy("series").text(root)
    read = read_payload_files(s, root, on_error="skip")
    points = (explode_payload(read, keep_cols=["series"]).groupBy("series")
              .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("point")))
    rejects = (payload_rejects(read, keep_cols=["series"]).groupBy("series")
               .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("reject")))
    return points.unionByName(rejects)


def _payload_points(s, d) -> DataFrame:
    """Documents with strays among their points and values of another shape, and documents
    cut short: each point judged by itself, counted by series and reason."""
    pts = fx.points_dirty(s, d).withColumn("page", F.floor(F.col("event_id") / fx.PAYLOAD_PAGE))
    entry = (F.when(F.col("event_id") % 11 == 3, F.lit('"stray"'))
             .when(F.col("event_id") % 13 == 5, F.to_json(F.struct(
                 "period", F.struct(F.lit(1).alias("v")).alias("value"))))
             .otherwise(F.to_json(F.struct("period", "value"))))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", entry.alias("e")))),
                         lambda x: x["e"])  # a page is a range of ids: its size is bounded
    body = F.concat(F.lit('{"response":{"data":['), F.array_join(listed, ","), F.lit("]}}"))
    pages = pts.groupBy("series", "page").agg(body.alias("body"))
    cut = F.when(F.col("page") % 7 == 0, F.expr("left(body, length(body) - 3)")).otherwise(F.col("body"))
    points = parse_points(pages.select("series", cut.alias("body")), "body", ["series"])
    return (points.groupBy("series", F.coalesce("reject", F.lit("ok")).alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))


def _ohlcv_dirty(s, d) -> DataFrame:
    bars = weekly_bars(fx.ticks_dirty(s, d), key_cols=["ticker"], time_col="day",
                       price_col="p", volume_col="n", places=None)
    return clean_bars(bars)


def _stage_typed(s, d) -> DataFrame:
    """A batch without constant columns and load time, typed and filled."""
    batch = fx.fuel_weekly(s, d).select(F.col("week_date").cast("string").alias("week_date"),
                                        F.col("regular").cast("string").alias("regular"), "diesel")
    return stage(batch, NATIONAL, run_ts=RUN_TS, defaults={
        "region": fx.NATIONAL_REGION, "price_unit": fx.PRICE_UNIT, "source": fx.NATIONAL_SOURCE})


def _readback(s, d) -> DataFrame:
    """Full refresh twice, a log appended by three runs of which one repeats, and a
    replaced view, each read back (B4, B5, B6)."""
    root = f"{ensure_checkpoint_dir(s).rstrip('/')}/readback/{uuid.uuid4().hex}"
    table = fx.regional_weekly(s, d)
    publish(table.filter("region = 'ASIA'"), f"{root}/t")
    publish(table, f"{root}/t")
    for run in ("r1", "r2", "r2"):
        append_run(table.groupBy("region").count(), f"{root}/log", run)
    view = f"readback_{uuid.uuid4().hex}"
    replace_view(table, view)
    replace_view(read_version(s, f"{root}/t").filter("price IS NOT NULL"), view)
    parts = {"table": read_version(s, f"{root}/t"), "log": s.read.parquet(f"{root}/log"),
             "view": s.table(view)}
    out = None
    for name, df in parts.items():
        one = df.groupBy("region").count().select(F.lit(name).alias("kind"), "region",
                                                  F.col("count").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def _final_many(s, d) -> DataFrame:
    fc = FC.forecast_drift(fx.many_series(s, d), series_col="series", target_col="price",
                           horizon=HORIZON, level=LEVEL)
    return FC.history_plus_forecast(fx.many_series(s, d), fc, series_col="series",
                                    target_col="price")


SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "vol_many_series": _vol_many,
    "vol_regular": lambda s, d: vol_model(s, d, "regular"),
    "crude_margin_regular": lambda s, d: crude_model(s, d, "regular"),
    "ma_many_series": _ma_many,
    "pivot_grades": _pivot,
    "vol_weekly": lambda s, d: vol_model(s, d),
    "vol_label_share": lambda s, d: RP.label_share(vol_model(s, d), label_col="volatility_label"),
    "ma_weekly": lambda s, d: ma_model(s, d),
    "grade_spread": lambda s, d: ma_model(s, d).select(
        "week_date", "region", "regular", "premium", "diesel", "premium_spread", "diesel_spread"),
    "crude_lag_margin": lambda s, d: crude_model(s, d),
    "region_spread": lambda s, d: regional_model(s, d),
    "region_rank": lambda s, d: RP.region_ranking(regional_model(s, d))
        .withColumn("spread_rank", F.col("spread_rank").cast("long")),
    "region_box": lambda s, d: RP.box_stats(fx.regional_weekly(s, d), group_col="region",
                                            value_col="price"),
    "latest_n_per_series": lambda s, d: latest_per_series(
        fx.regional_weekly(s, d), "region", "week_date", LATEST_REGIONAL),
    "ohlcv_weekly": lambda s, d: fx.market_weekly(s, d),
    "ohlcv_clean": lambda s, d: conform(
        clean_bars(_market_raw_bars(s, d)).withColumn("ticker_name", fx.ticker_name_col())
        .withColumn("load_ts", fx.load_ts_lit()), MARKET),
    "trailing_window": lambda s, d: trailing_window(fx.market_weekly(s, d), time_col="week_date",
                                                    months=RETENTION_MONTHS),
    "json_series": lambda s, d: flatten_series(
        payload_points(s, d), period_col="period", value_col="value", keep_cols=["series"],
    ).withColumn("period", F.col("period").try_cast("date")),
    "upsert_fuel": lambda s, d: upserted_national(s, d),
    "upsert_regional": lambda s, d: keyed_upsert(
        fx.regional_weekly(s, d), revised_regional(s, d), REGIONAL_KEY, run_ts=RUN_TS,
        on_duplicate="assume_unique"),
    "upsert_market": lambda s, d: keyed_upsert(
        fx.market_weekly(s, d), revised_market(s, d), MARKET_KEY, run_ts=RUN_TS,
        on_duplicate="assume_unique"),
    "scd2_history": lambda s, d: history_runs(s, d),
    "scd2_as_of": lambda s, d: H.as_of(history_runs(s, d), AS_OF),
    "train_set": lambda s, d: FC.training_set(fx.fuel_weekly(s, d)),
    "forecast_drift": lambda s, d: FC.forecast_drift(
        fx.many_series(s, d), series_col="series", target_col="price", horizon=HORIZON, level=LEVEL),
    "forecast_trend": lambda s, d: FC.forecast_trend(
        fx.many_series(s, d), series_col="series", target_col="price", horizon=HORIZON, level=LEVEL),
    "forecast_pooled": lambda s, d: FC.forecast_pooled(
        fx.many_series(s, d), series_col="series", target_col="price", horizon=HORIZON, level=LEVEL),
    "history_plus_forecast": lambda s, d: final_table(s, d),
    "backtest_metrics": lambda s, d: MT.error_metrics(
        MT.backtest_drift(fx.many_series(s, d), series_col="series", target_col="price",
                          horizon=HORIZON, level=LEVEL), run_ts=RUN_TS),
    "check_not_null": lambda s, d: _checks(s, d, CK.NOT_NULL),
    "check_accepted": lambda s, d: _checks(s, d, CK.ACCEPTED),
    "check_suite": lambda s, d: _checks(s, d),
    "report_counts": lambda s, d: RP.table_counts({
        **published_tables(s, d),
        "fuel_price_forecast": national_forecast(s, d),
        "fuel_price_final": final_table(s, d)}),
    "ticker_counts": lambda s, d: RP.count_by(fx.market_weekly(s, d), "ticker"),
    "latest_price": lambda s, d: RP.latest_value(fx.regional_weekly(s, d), series_col="region",
                                                 time_col="week_date", value_col="price"),
    "forecast_card": lambda s, d: RP.forecast_card(final_table(s, d)),
    "crude_scatter_stats": lambda s, d: RP.relation_stats(
        crude_model(s, d), x="crude_lag2_gal", y="all_grades"),
    "ticker_overview": lambda s, d: RP.ticker_overview(fx.market_weekly(s, d)),
    "tolerant_parse": lambda s, d: flatten_series(
        fx.points_dirty(s, d), period_col="period", value_col="value", keep_cols=["series"],
    ).withColumn("period", F.col("period").try_cast("date")),
    "payload_files": _payload_files,
    "payload_points": _payload_points,
    "ohlcv_dirty": _ohlcv_dirty,
    "stage_typed": _stage_typed,
    "publish_readback": _readback,
    "vol_national_scope": lambda s, d: price_volatility(fx.national_dirty(s, d), scope=SCOPE),
    "ma_national_scope": lambda s, d: price_moving_avg(fx.national_dirty(s, d), scope=SCOPE),
    "crude_national_scope": lambda s, d: lagged_margin(
        fx.national_dirty(s, d), fx.market_weekly(s, d), ticker=fx.CRUDE_TICKER, scope=SCOPE),
    "train_national_scope": lambda s, d: FC.training_set(fx.national_dirty(s, d), scope=SCOPE),
    "forecast_drift_nulls": lambda s, d: FC.forecast_drift(
        fx.national_dirty(s, d), horizon=HORIZON, level=LEVEL),
    "forecast_trend_nulls": lambda s, d: FC.forecast_trend(
        fx.national_dirty(s, d), horizon=HORIZON, level=LEVEL),
    "crude_margin_many": lambda s, d: lagged_margin(
        fx.many_series(s, d), fx.market_weekly(s, d), ticker=fx.CRUDE_TICKER, retail_col="price",
        other_cols=(), retail_keys=("series",)),
    "final_many": _final_many,
    "region_spread_many": many_model,
    "region_spread_ordered": spread_in_order,
    "series_rank": lambda s, d: RP.series_ranking(many_model(s, d), region_col="series"),
    "price_box": lambda s, d: RP.box_stats_unbounded(
        read_table(s, d, "orders", ["o_orderpriority", "o_totalprice"]),
        group_col="o_orderpriority", value_col="o_totalprice"),
    "events_rolling": long_series,
}


SPARK |= CF.SPARK
SPARK = {k: SPARK[k] for k in sorted(SPARK)}


# ================================================================ SQL side ===
def _frame(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def sql_national(name="nat", src="fx_fuel") -> str:
    return f"{name} AS (SELECT {', '.join(NAT_COLS)} FROM {src})"


def _numbered(name: str, src: str, key: str, cols: str, where: str) -> str:
    """Rows of each series numbered by week: lags and frames become joins on the number."""
    return (f"{name} AS (SELECT {key} AS k, week_date, {cols}, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY week_date) AS i FROM {src} WHERE {where})")


def _bands(name: str, rows: list[tuple[str, str, str]]) -> str:
    """Label table: a value belongs to the row with above < value <= upto."""
    return (f"{name}(above, upto, label) AS (VALUES "
            + ", ".join(f"({lo}, {hi}, {q(label)})" for lo, hi, label in rows) + ")")


_INF = "cast('infinity' AS double)"


def _label(bands: str, value: str) -> str:
    """Label of ``value``; NULL gets the table's lowest row."""
    return (f"(SELECT b.label FROM {bands} b WHERE coalesce({value}, -{_INF}) > b.above "
            f"AND coalesce({value}, -{_INF}) <= b.upto OR (b.above = -{_INF} "
            f"AND coalesce({value}, -{_INF}) = -{_INF}))")


def sql_vol(name="vol", src="fx_fuel", price="all_grades", other="diesel", key="region",
            scope="") -> str:
    has = f"{price} IS NOT NULL{scope}"
    cols = f"{price} AS p" + (f", {other} AS o" if other else "")
    more = f", r.o AS {other}" if other else ""
    d_other = f", {R('r.o - e.o')} AS {other}_wow_change" if other else ""
    direction = f"CASE WHEN d < -0.05 THEN 'Falling' WHEN d > 0.05 THEN 'Rising' ELSE 'Stable' END"
    vol = _bands(f"{name}_b", [("0.3", _INF, VOLATILITY_LABELS[0]),
                               ("0.15", "0.3", VOLATILITY_LABELS[1]),
                               (f"-{_INF}", "0.15", VOLATILITY_LABELS[2])])
    o_out = (f"{other}, ", f"{other}_wow_change, ") if other else ("", "")
    return f"""{_numbered(f'{name}_n', src, key, cols, has)},
{vol},
{name}_a AS (SELECT k, avg(p) AS mean FROM {name}_n GROUP BY k),
{name}_s AS (
  SELECT r.k, r.i, stddev_samp(f.p) AS sd
  FROM {name}_n r JOIN {name}_n f ON f.k = r.k AND f.i BETWEEN r.i - 11 AND r.i GROUP BY r.k, r.i),
{name}_d AS (
  SELECT r.k AS {key}, r.week_date, r.p AS {price}{more}, {R('r.p - e.p')} AS d{d_other},
    CASE WHEN e.p > 0 THEN {R('100 * ((r.p - e.p) / e.p)')} END AS pct,
    a.mean AS mean, s.sd AS sd
  FROM {name}_n r LEFT JOIN {name}_n e ON e.k = r.k AND e.i = r.i - 1
  JOIN {name}_a a ON a.k = r.k JOIN {name}_s s ON s.k = r.k AND s.i = r.i),
{name} AS (
  SELECT {key}, week_date, {price}, {o_out[0]}d AS {price}_wow_change, {o_out[1]}
    pct AS {price}_wow_pct_change, {direction} AS price_direction,
    {_label(f'{name}_b', 'sd')} AS volatility_label, {R('sd')} AS rolling_12wk_stddev,
    {R('mean')} AS hist_avg_{price}, {R(f'{price} - mean')} AS price_anomaly
  FROM {name}_d)"""


def sql_ma(name="ma", src="fx_fuel") -> str:
    w = "PARTITION BY region ORDER BY week_date"
    cols = [f"{R(f'avg({c}) OVER ({w} {_frame(n)})')} AS {c}_{n}wk_avg"
            for n in (4, 12, 52) for c in ("regular", "diesel")]
    return f"""{name} AS (
  SELECT week_date, region, regular, diesel, midgrade, premium,
    {', '.join(cols)},
    {R('premium - regular')} AS premium_spread, {R('diesel - regular')} AS diesel_spread
  FROM {src} WHERE regular IS NOT NULL)"""


def sql_vol_many(name="vm", src="fx_many") -> str:
    return sql_vol(name, src, price="price", other="", key="series")


def sql_ma_many(name="mm", src="fx_many") -> str:
    w = "PARTITION BY series ORDER BY week_date"
    cols = [f"{R(f'avg(price) OVER ({w} {_frame(n)})')} AS price_{n}wk_avg" for n in (4, 12, 52)]
    return f"""{name} AS (
  SELECT week_date, series, price, {', '.join(cols)} FROM {src} WHERE price IS NOT NULL)"""


def sql_crude(name="crude", price="all_grades", src="fx_fuel", scope="", keep="") -> str:
    keep = f"{keep}, " if keep else ""
    bands = _bands(f"{name}_b", [("1.5", _INF, MARGIN_LABELS[0]), ("0.8", "1.5", MARGIN_LABELS[1]),
                                 (f"-{_INF}", "0.8", MARGIN_LABELS[2])])
    return f"""{_numbered(f'{name}_n', 'fx_market', 'ticker',
                          f"close AS bbl, {R('close / 42.0')} AS gal",
                          f'close IS NOT NULL AND ticker = {q(fx.CRUDE_TICKER)}')},
{bands},
{name}_two AS (
  SELECT b.week_date, b.bbl, b.gal, e.bbl AS bbl2, e.gal AS gal2
  FROM {name}_n b LEFT JOIN {name}_n e ON e.i + 2 = b.i),
{name}_m AS (
  SELECT {keep}f.week_date, f.{price}, f.diesel, t.* EXCLUDE (week_date),
    {R(f'f.{price} - CASE WHEN t.gal2 IS NULL THEN t.gal ELSE t.gal2 END')} AS margin
  FROM {src} f LEFT JOIN {name}_two t USING (week_date) WHERE f.{price} IS NOT NULL{scope}),
{name} AS (
  SELECT {keep}week_date, {price}, diesel, bbl AS crude_close_usd_bbl, gal AS crude_usd_per_gallon,
    bbl2 AS crude_lag2_bbl, gal2 AS crude_lag2_gal, margin AS pump_to_crude_margin,
    {_label(f'{name}_b', 'margin')} AS margin_category
  FROM {name}_m)"""


def sql_regcmp(name="rc", src="fx_fuel", scope="", table="fx_regional", key="region",
               kind=f" AND fuel_type = {q(fx.FUEL_TYPE)}") -> str:
    edges = ["0.3", "0.1", "-0.1", "-0.3"]
    bands = _bands(f"{name}_b", [
        (lo, hi, label) for lo, hi, label in zip(edges + [f"-{_INF}"], [_INF] + edges,
                                                 CATEGORY_LABELS)])
    return f"""{_numbered(f'{name}_n', table, key, 'price', f'price IS NOT NULL{kind}')},
{bands},
{name}_w AS (SELECT week_date, regular AS base FROM {src} WHERE regular IS NOT NULL{scope}),
{name}_p AS (
  SELECT r.*, w.base, {R('r.price - w.base')} AS gap,
    CASE WHEN w.base > 0 THEN {R('100 * ((r.price - w.base) / w.base)', 2)} END AS gap_pct
  FROM {name}_n r LEFT JOIN {name}_w w USING (week_date)),
{name}_f AS (
  SELECT r.k, r.i, avg(f.price) FILTER (WHERE f.i > r.i - 4) AS mean4, max(f.gap) AS widest
  FROM {name}_p r JOIN {name}_p f ON f.k = r.k AND f.i <= r.i GROUP BY r.k, r.i),
{name} AS (
  SELECT p.week_date, p.k AS {key}, p.price AS regional_price, p.base AS national_price,
    p.gap AS price_spread, p.gap_pct AS price_spread_pct, {R('f.mean4')} AS regional_4wk_avg,
    {R('f.widest')} AS max_spread_seen, {_label(f'{name}_b', 'p.gap')} AS price_category
  FROM {name}_p p JOIN {name}_f f ON f.k = p.k AND f.i = p.i)"""


def sql_drift(name, src, s, t, y) -> str:
    return f"""{name}_steps AS (
  SELECT {s} AS s_key, {t} AS t, {y} AS y,
    {y} - lag({y}) OVER (PARTITION BY {s} ORDER BY {t}) AS dy
  FROM {src} WHERE {y} IS NOT NULL),
{name}_fit AS (
  SELECT s_key, count(y) AS n, arg_min(y, t) AS y_first, arg_max(y, t) AS y_last,
    max(t) AS last_t, stddev_samp(dy) AS s
  FROM {name}_steps GROUP BY s_key HAVING count(y) >= 3),
{name}_h AS (
  SELECT *, (y_last - y_first) / (n - 1) AS d, unnest(generate_series(1, {HORIZON})) AS h
  FROM {name}_fit),
{name}_c AS (
  SELECT *, y_last + h * d AS c, {ZSQL} * s * sqrt(h * (1.0 + h / (n - 1))) AS hw FROM {name}_h),
{name} AS (
  SELECT s_key AS series, cast(last_t + cast(7 * h AS integer) AS timestamp) AS ts, {R('c')} AS forecast,
    {R('c - hw')} AS lower_bound, {R('c + hw')} AS upper_bound
  FROM {name}_c)"""


def sql_trend(name, src, s, t, y) -> str:
    x = f"cast(datediff('day', DATE {q(FC.WEEK_ORIGIN)}, {t}) AS double) / cast(7 AS double)"
    return f"""{name}_pts AS (
  SELECT {s} AS s_key, {t} AS t, {y} AS y, {x} AS x FROM {src} WHERE {y} IS NOT NULL),
{name}_fit AS (
  SELECT s_key, regr_count(y, x) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
    regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, regr_avgx(y, x) AS xbar,
    max(x) AS last_x, max(t) AS last_t
  FROM {name}_pts GROUP BY s_key HAVING regr_count(y, x) >= 3 AND regr_sxx(y, x) > 0),
{name}_h AS (
  SELECT *, unnest(generate_series(1, {HORIZON})) AS h FROM {name}_fit),
{name}_c AS (
  SELECT *, a + b * (last_x + h) AS c,
    {ZSQL} * (sqrt(greatest(syy - sxy * sxy / sxx, 0.0) / (n - 2))
      * sqrt(1.0 + 1.0 / n + ((last_x + h) - xbar) * ((last_x + h) - xbar) / sxx)) AS hw
  FROM {name}_h),
{name} AS (
  SELECT s_key AS series, cast(last_t + cast(7 * h AS integer) AS timestamp) AS ts, {R('c')} AS forecast,
    {R('c - hw')} AS lower_bound, {R('c + hw')} AS upper_bound
  FROM {name}_c)"""


def sql_final(name="final") -> str:
    return f"""{sql_drift('nfc', 'fx_fuel', 'region', 'week_date', 'regular')},
{name} AS (
  SELECT region, week_date, cast(regular AS double) AS actual, cast(NULL AS double) AS forecast,
    cast(NULL AS double) AS lower_bound, cast(NULL AS double) AS upper_bound,
    'HISTORICAL' AS record_type
  FROM fx_fuel
  UNION ALL
  SELECT replace(series, '"', '') AS region, cast(ts AS date) AS week_date,
    cast(NULL AS double) AS actual, forecast, lower_bound, upper_bound, 'FORECAST' AS record_type
  FROM nfc)"""


def sql_revised_national(name="rev") -> str:
    grades = ",\n    ".join(
        f"{R(O.MEAN('cast(l_extendedprice AS decimal(12,2))', f'l_returnflag = {q(f)}') + f' / {REVISION_SCALE}')} AS {g}"
        for g, f in REVISION_FLAGS.items())
    diesel = R(O.MEAN("cast(l_extendedprice AS decimal(12,2))",
                      f"l_linestatus = {q(REVISION_DIESEL_STATUS)}") + f" / {REVISION_SCALE}")
    return f"""{name} AS (
  SELECT {WEEK('l_shipdate')} AS week_date, {q(fx.NATIONAL_REGION)} AS region,
    {grades},
    {diesel} AS diesel, {q(fx.PRICE_UNIT)} AS price_unit, {q(fx.NATIONAL_SOURCE)} AS source,
    {RUN_TS_SQL} AS load_ts
  FROM lineitem GROUP BY 1)"""


def sql_latest_national(name="revl", src="rev") -> str:
    return f"""{name} AS (
  SELECT {', '.join(NAT_COLS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY region ORDER BY week_date DESC) AS rn FROM {src})
  WHERE rn <= {LATEST_NATIONAL})"""


def sql_upsert(name, target, batch, keys, cols) -> str:
    on = " AND ".join(f"b.{k} = t.{k}" for k in keys)
    c = ", ".join(cols)
    return f"""{name} AS (
  SELECT {c} FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {batch} b WHERE {on})
  UNION ALL
  SELECT {c} FROM {batch})"""


def sql_history(name="hist") -> str:
    keys = list(NATIONAL_KEY)
    data = NAT_COLS
    sid = lambda p: f"md5(concat_ws('|', {', '.join(f'cast({p}{k} AS varchar)' for k in keys)}, cast({p}load_ts AS varchar)))"
    s_cols = ", ".join(f"s.{c} AS s_{c}" for c in data)
    c_cols = ", ".join(f"c.{c} AS c_{c}" for c in (*data, *H.META))
    on = " AND ".join(f"s.{k} = c.{k}" for k in keys)
    all_cols = ", ".join([*data, *H.META])
    return f"""{sql_national('nat')},
{sql_revised_national('rev')},
{sql_latest_national('revl', 'rev')},
{sql_upsert('ups', 'nat', 'revl', keys, NAT_COLS)},
src2 AS (SELECT * FROM ups WHERE extract(day FROM week_date) <> {WITHDRAWN_DAY}),
h1 AS (
  SELECT {', '.join(data)}, {sid('')} AS scd_id, load_ts AS updated_at, load_ts AS valid_from,
    cast(NULL AS timestamp) AS valid_to
  FROM nat),
hj AS (
  SELECT {s_cols}, {c_cols}, s.week_date IS NOT NULL AS s_in, c.week_date IS NOT NULL AS c_in
  FROM (SELECT *, 1 AS one FROM src2) s
  FULL OUTER JOIN (SELECT * FROM h1 WHERE valid_to IS NULL) c ON {on}),
{name} AS (
  SELECT {all_cols} FROM h1 WHERE valid_to IS NOT NULL
  UNION ALL
  SELECT {', '.join(f's_{c}' for c in data)}, {sid('s_')}, s_load_ts, s_load_ts,
    cast(NULL AS timestamp)
  FROM hj WHERE s_in AND (NOT c_in OR s_load_ts > c_valid_from)
  UNION ALL
  SELECT {', '.join(f'c_{c}' for c in data)}, c_scd_id, c_updated_at, c_valid_from,
    CASE WHEN NOT s_in THEN {RUN_TS_SQL} WHEN s_load_ts > c_valid_from THEN s_load_ts END
  FROM hj WHERE c_in)"""


def sql_pooled(name="pool", src="fx_many") -> str:
    held = f"a.rd > {HORIZON} AND a.rd <= {2 * HORIZON}"
    return f"""{name}_n AS (
  SELECT series, week_date, price AS y,
    row_number() OVER (PARTITION BY series ORDER BY week_date) AS i,
    row_number() OVER (PARTITION BY series ORDER BY week_date DESC) AS rd
  FROM {src} WHERE price IS NOT NULL),
{name}_x AS (
  SELECT a.series, a.week_date, a.i, a.rd, a.y, a.y - avg(b.y) AS x
  FROM {name}_n a JOIN {name}_n b
    ON a.series = b.series AND b.i BETWEEN a.i - {FC.POOLED_MEAN - 1} AND a.i
  GROUP BY a.series, a.week_date, a.i, a.rd, a.y),
{name}_p AS (
  SELECT b.i - a.i AS h, a.rd, a.x, b.y - a.y AS t FROM {name}_x a JOIN {name}_n b
    ON a.series = b.series AND b.i BETWEEN a.i + 1 AND a.i + {HORIZON}),
{name}_all AS (
  SELECT h, regr_intercept(t, x) AS a, regr_slope(t, x) AS b FROM {name}_p GROUP BY h),
{name}_old AS (
  SELECT h, regr_intercept(t, x) AS a, regr_slope(t, x) AS b FROM {name}_p
  WHERE rd > {3 * HORIZON} GROUP BY h),
{name}_err AS (
  SELECT a.h, sqrt(avg((a.t - o.a - o.b * a.x) * (a.t - o.a - o.b * a.x))) AS rms
  FROM {name}_p a JOIN {name}_old o ON a.h = o.h WHERE {held} GROUP BY a.h),
{name} AS (
  SELECT n.series, cast(n.week_date + cast(7 * l.h AS integer) AS timestamp) AS ts,
    {R('n.y + l.a + l.b * n.x')} AS forecast,
    {R(f'n.y + l.a + l.b * n.x - {ZSQL} * e.rms')} AS lower_bound,
    {R(f'n.y + l.a + l.b * n.x + {ZSQL} * e.rms')} AS upper_bound
  FROM {name}_x n JOIN {name}_all l ON n.rd = 1 LEFT JOIN {name}_err e ON e.h = l.h)"""


def _readback_sql() -> str:
    return W(O.FX_REGIONAL) + """SELECT 'table' AS kind, region, count(*) AS n FROM fx_regional GROUP BY region
UNION ALL SELECT 'log', region, 2 FROM fx_regional GROUP BY region
UNION ALL SELECT 'view', region, count(*) FROM fx_regional WHERE price IS NOT NULL GROUP BY region"""


def _final_many_sql() -> str:
    none = "cast(NULL AS double)"
    return W(O.FX_MANY, sql_drift("fc", "fx_many", "series", "week_date", "price")) + f"""
SELECT series AS region, week_date, price AS actual, {none} AS forecast, {none} AS lower_bound,
  {none} AS upper_bound, 'HISTORICAL' AS record_type FROM fx_many
UNION ALL
SELECT series, cast(ts AS date), {none}, forecast, lower_bound, upper_bound, 'FORECAST' FROM fc"""


def sql_backtest(name="bt") -> str:
    return f"""{name}_r AS (
  SELECT series, week_date, price,
    lag(price) OVER (PARTITION BY series ORDER BY week_date) AS prev_actual,
    row_number() OVER (PARTITION BY series ORDER BY week_date DESC) AS rd
  FROM fx_many WHERE price IS NOT NULL),
{name}_steps AS (
  SELECT series, week_date, price,
    price - lag(price) OVER (PARTITION BY series ORDER BY week_date) AS dy
  FROM {name}_r WHERE rd > {HORIZON}),
{name}_fit AS (
  SELECT series, count(price) AS n, arg_min(price, week_date) AS y_first,
    arg_max(price, week_date) AS y_last, stddev_samp(dy) AS s
  FROM {name}_steps GROUP BY series HAVING count(price) >= 3),
{name}_j AS (
  SELECT t.series, {HORIZON + 1} - t.rd AS h, t.price AS actual, t.prev_actual,
    f.n, f.y_last, f.s, (f.y_last - f.y_first) / (f.n - 1) AS d
  FROM {name}_r t JOIN {name}_fit f ON t.series = f.series WHERE t.rd <= {HORIZON}),
{name} AS (
  SELECT series, h, actual, prev_actual,
    {R('y_last + h * d')} AS forecast,
    {R(f'(y_last + h * d) - {ZSQL} * s * sqrt(h * (1.0 + h / (n - 1)))')} AS lower_bound,
    {R(f'(y_last + h * d) + {ZSQL} * s * sqrt(h * (1.0 + h / (n - 1)))')} AS upper_bound
  FROM {name}_j)"""


def sql_metrics(by=(), bt="bt") -> str:
    by = "".join(f", {c}" for c in by)
    one, zero = "cast(1 AS double)", "cast(0 AS double)"
    terms = {
        "MAE": "abs(actual - forecast)",
        "MAPE": "CASE WHEN actual <> 0 THEN abs((actual - forecast) / actual) END",
        "SMAPE": "CASE WHEN (abs(actual) + abs(forecast)) <> 0 THEN 2.0 * abs(actual - forecast) / (abs(actual) + abs(forecast)) END",
        "MSE": "(actual - forecast) * (actual - forecast)",
        "MDA": f"CASE WHEN prev_actual IS NOT NULL THEN CASE WHEN sign(actual - prev_actual) = sign(forecast - prev_actual) THEN {one} ELSE {zero} END END",
        "COVERAGE": f"CASE WHEN actual >= lower_bound AND actual <= upper_bound THEN {one} ELSE {zero} END",
        "WINKLER": f"(upper_bound - lower_bound) + CASE WHEN actual < lower_bound THEN cast(40.0 AS double) * (lower_bound - actual) ELSE {zero} END + CASE WHEN actual > upper_bound THEN cast(40.0 AS double) * (actual - upper_bound) ELSE {zero} END",
    }
    parts = [f"""SELECT {RUN_TS_SQL} AS run_ts, series{by}, {q(n)} AS error_metric,
    {R(f'avg({e})')} AS metric_value, {R(f'stddev_samp({e})')} AS standard_deviation,
    cast(NULL AS varchar) AS logs
  FROM {bt} GROUP BY series{by}""" for n, e in terms.items()]
    return "\nUNION ALL\n".join(parts)


def _table_cte(name: str) -> str:
    return {
        "fuel_prices": "nat", "regional_fuel_prices": "fx_regional",
        "energy_market_prices": "fx_market", "price_moving_avg": "ma",
        "price_volatility": "volr", "crude_correlation": "crr", "regional_comparison": "rc",
    }[name]


ALL_MODELS = (O.FX_FUEL, O.FX_REGIONAL, O.FX_MARKET, sql_national("nat"), sql_ma(),
              sql_vol("volr", price="regular"), sql_crude("crr", price="regular"), sql_regcmp())


def sql_checks(test=None) -> str:
    parts = []
    for ch in suite_checks():
        if test is not None and ch.test != test:
            continue
        src = _table_cte(ch.table)
        if ch.test == CK.NOT_NULL:
            f = f"count(*) FILTER (WHERE {ch.column} IS NULL)"
        else:
            vals = ", ".join(q(v) for v in ch.values)
            f = f"count(DISTINCT CASE WHEN {ch.column} NOT IN ({vals}) THEN {ch.column} END)"
        parts.append(f"SELECT {q(ch.table)} AS table_name, {q(ch.column)} AS column_name, "
                     f"{q(ch.test)} AS test_name, cast({f} AS bigint) AS failures FROM {src}")
    body = "\nUNION ALL\n".join(parts)
    return O.with_(*ALL_MODELS) + f"""SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (\n{body}\n) x"""


def _pivot_sql() -> str:
    v = R("try_cast(value AS double)")
    sel = ",\n  ".join(
        f"arg_max({v}, event_id) FILTER (WHERE series = {q(et)} AND {v} IS NOT NULL) AS {g}"
        for et, g in EVENT_GRADES.items())
    ets = ", ".join(q(e) for e in EVENT_GRADES)
    return O.with_(O.FX_POINTS) + f"""SELECT try_cast(period AS date) AS period,
  {sel}
FROM fx_points
WHERE series IN ({ets}) AND period IS NOT NULL AND period <> '' AND value IS NOT NULL
GROUP BY period"""


def _revised_regional_sql() -> str:
    return f"""rreg_all AS (
  SELECT {WEEK('l.l_shipdate')} AS week_date, r.r_name AS region,
    {R(O.MEAN('cast(l.l_extendedprice AS decimal(12,2))') + f' / {REVISION_SCALE}')} AS price,
    {q(fx.FUEL_TYPE)} AS fuel_type, {q(fx.PRICE_UNIT)} AS price_unit,
    {q(fx.REGIONAL_SOURCE)} AS source, {RUN_TS_SQL} AS load_ts
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2),
rreg AS (
  SELECT {', '.join(REG_COLS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY region ORDER BY week_date DESC) AS rn FROM rreg_all)
  WHERE rn <= {LATEST_REGIONAL})"""


def _revised_market_sql() -> str:
    return f"""rdaily AS (
  SELECT l_returnflag AS ticker, cast(l_shipdate AS date) AS day,
    {O.MEAN('cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(3,2)))')} / {fx.BAR_SCALE} AS p, count(*) AS n
  FROM lineitem GROUP BY 1, 2),
rbars AS (
  SELECT {WEEK('day')} AS week_date, ticker, {O._TICKER_CASE} AS ticker_name,
    {R('arg_min(p, day)')} AS open, {R('max(p)')} AS high, {R('min(p)')} AS low,
    {R('arg_max(p, day)')} AS close, cast(sum(n) AS bigint) AS volume, {RUN_TS_SQL} AS load_ts
  FROM rdaily GROUP BY 1, 2),
rmkt AS (
  SELECT {', '.join(MKT_COLS)} FROM rbars
  WHERE week_date >= (SELECT max(week_date) FROM rbars) - INTERVAL {RETENTION_MONTHS} MONTH)"""


W = O.with_
MANY_SPREAD = sql_regcmp("rm", table="fx_many", key="series", kind="")
NATIONAL_ONLY = f" AND region = {q(fx.NATIONAL_REGION)}"
SQL: dict[str, str] = {
    "vol_weekly": W(O.FX_FUEL, sql_vol()) + "SELECT * FROM vol",
    "vol_many_series": W(O.FX_MANY, sql_vol_many()) + "SELECT * FROM vm",
    "vol_regular": W(O.FX_FUEL, sql_vol("volr", price="regular")) + "SELECT * FROM volr",
    "crude_margin_regular": W(O.FX_FUEL, O.FX_MARKET, sql_crude("crr", price="regular"))
        + "SELECT * FROM crr",
    "ma_many_series": W(O.FX_MANY, sql_ma_many()) + "SELECT * FROM mm",
    "vol_label_share": W(O.FX_FUEL, sql_vol()) + f"""SELECT volatility_label, count(*) AS n_weeks,
  {R('count(*) * cast(100 AS double) / (SELECT count(*) FROM vol)', 2)} AS pct_weeks
FROM vol GROUP BY volatility_label""",
    "ma_weekly": W(O.FX_FUEL, sql_ma()) + "SELECT * FROM ma",
    "grade_spread": W(O.FX_FUEL, sql_ma()) +
        "SELECT week_date, region, regular, premium, diesel, premium_spread, diesel_spread FROM ma",
    "crude_lag_margin": W(O.FX_FUEL, O.FX_MARKET, sql_crude()) + "SELECT * FROM crude",
    "region_spread": W(O.FX_FUEL, O.FX_REGIONAL, sql_regcmp()) + "SELECT * FROM rc",
    "region_rank": W(O.FX_FUEL, O.FX_REGIONAL, sql_regcmp()) + f"""SELECT *,
  rank() OVER (ORDER BY avg_spread_pct DESC) AS spread_rank FROM (
  SELECT region, {R('avg(price_spread_pct)')} AS avg_spread_pct, min(price_spread_pct) AS min_spread_pct,
    max(price_spread_pct) AS max_spread_pct, count(price_spread_pct) AS n_weeks
  FROM rc GROUP BY region) g""",
    "region_box": W(O.FX_FUEL, O.FX_REGIONAL, sql_regcmp()) + f"""SELECT q.region, q.n,
  {R('q.min_value')} AS min_value, {R('q.q1')} AS q1, {R('q.median')} AS median, {R('q.q3')} AS q3,
  {R('q.max_value')} AS max_value, {R('q.q3 - q.q1')} AS iqr,
  {R('q.q1 - 1.5 * (q.q3 - q.q1)')} AS lower_fence, {R('q.q3 + 1.5 * (q.q3 - q.q1)')} AS upper_fence,
  (SELECT count(*) FROM rc x WHERE x.region = q.region AND
     (x.regional_price < q.q1 - 1.5 * (q.q3 - q.q1) OR x.regional_price > q.q3 + 1.5 * (q.q3 - q.q1))) AS n_outliers
FROM (SELECT region, count(regional_price) AS n, min(regional_price) AS min_value,
        quantile_cont(regional_price, 0.25) AS q1, quantile_cont(regional_price, 0.5) AS median,
        quantile_cont(regional_price, 0.75) AS q3, max(regional_price) AS max_value
      FROM rc WHERE regional_price IS NOT NULL GROUP BY region) q""",
    "pivot_grades": _pivot_sql(),
    "latest_n_per_series": W(O.FX_REGIONAL) + f"""SELECT {', '.join(REG_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY week_date DESC) AS rn FROM fx_regional)
WHERE rn <= {LATEST_REGIONAL}""",
    "ohlcv_weekly": W(O.FX_MARKET) + "SELECT * FROM fx_market",
    "ohlcv_clean": W(O.FX_MARKET) + f"SELECT {', '.join(MKT_COLS)} FROM fx_market WHERE close IS NOT NULL",
    "trailing_window": W(O.FX_MARKET) + f"""SELECT * FROM fx_market
WHERE week_date >= (SELECT max(week_date) FROM fx_market) - INTERVAL {RETENTION_MONTHS} MONTH""",
    "json_series": W(O.FX_POINTS) + f"""SELECT series, try_cast(period AS date) AS period,
  {R('try_cast(value AS double)')} AS price
FROM fx_points WHERE period IS NOT NULL AND period <> '' AND value IS NOT NULL
  AND {R('try_cast(value AS double)')} IS NOT NULL""",
    "upsert_fuel": W(O.FX_FUEL, sql_national(), sql_revised_national(), sql_latest_national(),
                     sql_upsert("ups", "nat", "revl", NATIONAL_KEY, NAT_COLS)) + "SELECT * FROM ups",
    "upsert_regional": W(O.FX_REGIONAL, _revised_regional_sql(),
                         sql_upsert("ups", "fx_regional", "rreg", REGIONAL_KEY, REG_COLS))
        + "SELECT * FROM ups",
    "upsert_market": W(O.FX_MARKET, _revised_market_sql(),
                       sql_upsert("ups", "fx_market", "rmkt", MARKET_KEY, MKT_COLS))
        + "SELECT * FROM ups",
    "scd2_history": W(O.FX_FUEL, sql_history()) + "SELECT * FROM hist",
    "scd2_as_of": W(O.FX_FUEL, sql_history()) + f"""SELECT * FROM hist
WHERE valid_from <= cast({q(AS_OF)} AS timestamp)
  AND (valid_to IS NULL OR valid_to > cast({q(AS_OF)} AS timestamp))""",
    "train_set": W(O.FX_FUEL) + "SELECT region, week_date, regular FROM fx_fuel WHERE regular IS NOT NULL",
    "forecast_drift": W(O.FX_MANY, sql_drift("fc", "fx_many", "series", "week_date", "price"))
        + "SELECT * FROM fc",
    "forecast_trend": W(O.FX_MANY, sql_trend("fc", "fx_many", "series", "week_date", "price"))
        + "SELECT * FROM fc",
    "history_plus_forecast": W(O.FX_FUEL, sql_final()) + "SELECT * FROM final",
    "backtest_metrics": W(O.FX_MANY, sql_backtest()) + sql_metrics(),
    "check_not_null": sql_checks(CK.NOT_NULL),
    "check_accepted": sql_checks(CK.ACCEPTED),
    "check_suite": sql_checks(),
    "report_counts": W(*ALL_MODELS, sql_final()) + "\nUNION ALL\n".join(
        [f"SELECT {q(t)} AS table_name, count(*) AS row_count FROM {_table_cte(t)}"
         for t in ("fuel_prices", "regional_fuel_prices", "energy_market_prices",
                   "price_moving_avg", "price_volatility", "crude_correlation",
                   "regional_comparison")]
        + ["SELECT 'fuel_price_forecast' AS table_name, count(*) AS row_count FROM nfc",
           "SELECT 'fuel_price_final' AS table_name, count(*) AS row_count FROM final"]),
    "ticker_counts": W(O.FX_MARKET) + "SELECT ticker, count(*) AS row_count FROM fx_market GROUP BY ticker",
    "latest_price": W(O.FX_REGIONAL) + """SELECT region, max(week_date) AS latest_week,
  arg_max(price, week_date) AS latest_value
FROM fx_regional WHERE price IS NOT NULL GROUP BY region""",
    "forecast_card": W(O.FX_FUEL, sql_final()) + """SELECT region, max(week_date) AS week_date,
  arg_max(forecast, week_date) AS forecast, arg_max(lower_bound, week_date) AS lower_bound,
  arg_max(upper_bound, week_date) AS upper_bound
FROM final WHERE record_type = 'FORECAST' GROUP BY region""",
    "crude_scatter_stats": W(O.FX_FUEL, O.FX_MARKET, sql_crude()) + f"""SELECT
  count(CASE WHEN crude_lag2_gal IS NOT NULL AND all_grades IS NOT NULL THEN 1 END) AS n_pairs,
  {R('corr(all_grades, crude_lag2_gal)')} AS correlation,
  {R('regr_slope(all_grades, crude_lag2_gal)')} AS slope,
  {R('regr_intercept(all_grades, crude_lag2_gal)')} AS intercept
FROM crude""",
    "ticker_overview": W(O.FX_MARKET) + f"""SELECT b.ticker, b.week_date, b.open, b.high, b.low, b.close,
  b.volume, p.prev_close, {R('b.close - p.prev_close')} AS change,
  CASE WHEN p.prev_close > 0 THEN {R('((b.close - p.prev_close) / p.prev_close) * 100', 2)} END AS change_pct
FROM fx_market b
JOIN (SELECT ticker, max(week_date) AS last_w FROM fx_market GROUP BY ticker) l
  ON b.ticker = l.ticker AND b.week_date = l.last_w
LEFT JOIN (SELECT m.ticker, arg_max(m.close, m.week_date) AS prev_close FROM fx_market m
           JOIN (SELECT ticker, max(week_date) AS last_w FROM fx_market GROUP BY ticker) l2
             ON m.ticker = l2.ticker AND m.week_date < l2.last_w
           GROUP BY m.ticker) p ON b.ticker = p.ticker""",
    "forecast_pooled": W(O.FX_MANY, sql_pooled()) + "SELECT * FROM pool",
    "tolerant_parse": W(O.FX_POINTS, O.FX_POINTS_DIRTY) + f"""SELECT series,
  try_cast(period AS date) AS period, {R('try_cast(value AS double)')} AS price
FROM fx_points_dirty WHERE period IS NOT NULL AND period <> '' AND value IS NOT NULL
  AND {R('try_cast(value AS double)')} IS NOT NULL""",
    "payload_files": W(O.FX_POINTS, O.FX_POINTS_DIRTY) + f"""
SELECT series, 'point' AS kind, count(*) AS n FROM fx_points_dirty
WHERE (event_id // {fx.PAYLOAD_PAGE}) % 7 <> 0 GROUP BY series
UNION ALL
SELECT series, 'reject', count(DISTINCT event_id // {fx.PAYLOAD_PAGE}) FROM fx_points_dirty
WHERE (event_id // {fx.PAYLOAD_PAGE}) % 7 = 0 GROUP BY series""",
    "payload_points": W(O.FX_POINTS, O.FX_POINTS_DIRTY) + f"""
SELECT series, CASE WHEN event_id % 11 = 3 THEN 'point' WHEN period IS NULL THEN 'period'
  WHEN event_id % 13 = 5 THEN 'value' ELSE 'ok' END AS kind, count(*) AS n
FROM fx_points_dirty WHERE (event_id // {fx.PAYLOAD_PAGE}) % 7 <> 0 GROUP BY 1, 2
UNION ALL
SELECT series, 'document', count(DISTINCT event_id // {fx.PAYLOAD_PAGE}) FROM fx_points_dirty
WHERE (event_id // {fx.PAYLOAD_PAGE}) % 7 = 0 GROUP BY series""",
    "ohlcv_dirty": W(O.FX_DAILY, O.FX_TICKS_DIRTY) + f"""SELECT {WEEK('day')} AS week_date, ticker,
  {R('arg_min(p, day) FILTER (WHERE p IS NOT NULL)')} AS open, {R('max(p)')} AS high,
  {R('min(p)')} AS low, {R('arg_max(p, day) FILTER (WHERE p IS NOT NULL)')} AS close,
  cast(sum(n) AS bigint) AS volume
FROM fx_ticks_dirty GROUP BY 1, 2 HAVING count(p) > 0""",
    "stage_typed": W(O.FX_FUEL) + f"""SELECT week_date, {q(fx.NATIONAL_REGION)} AS region, regular,
  cast(NULL AS double) AS midgrade, cast(NULL AS double) AS premium, diesel,
  {q(fx.PRICE_UNIT)} AS price_unit, {q(fx.NATIONAL_SOURCE)} AS source, {RUN_TS_SQL} AS load_ts
FROM fx_fuel""",
    "publish_readback": _readback_sql(),
    "vol_national_scope": W(O.FX_FUEL_DIRTY, sql_vol(
        src="fx_fuel_dirty", price="regular", scope=NATIONAL_ONLY)) + "SELECT * FROM vol",
    "ma_national_scope": W(O.FX_FUEL_DIRTY, sql_ma(
        src=f"(SELECT * FROM fx_fuel_dirty WHERE true{NATIONAL_ONLY})")) + "SELECT * FROM ma",
    "crude_national_scope": W(O.FX_FUEL_DIRTY, O.FX_MARKET, sql_crude(
        price="regular", src="fx_fuel_dirty", scope=NATIONAL_ONLY)) + "SELECT * FROM crude",
    "train_national_scope": W(O.FX_FUEL_DIRTY) + f"""SELECT region, week_date, regular
FROM fx_fuel_dirty WHERE regular IS NOT NULL{NATIONAL_ONLY}""",
    "forecast_drift_nulls": W(O.FX_FUEL_DIRTY, sql_drift(
        "fc", "fx_fuel_dirty", "region", "week_date", "regular")) + "SELECT * FROM fc",
    "forecast_trend_nulls": W(O.FX_FUEL_DIRTY, sql_trend(
        "fc", "fx_fuel_dirty", "region", "week_date", "regular")) + "SELECT * FROM fc",
    "crude_margin_many": W(O.FX_MANY, O.FX_MARKET, sql_crude(
        price="price", src="(SELECT *, cast(NULL AS double) AS diesel FROM fx_many)", keep="series"))
        + "SELECT * EXCLUDE (diesel) FROM crude",
    "final_many": _final_many_sql(),
    "region_spread_many": W(O.FX_FUEL, O.FX_MANY, MANY_SPREAD) + "SELECT * FROM rm",
    "region_spread_ordered": W(O.FX_FUEL, O.FX_REGIONAL, sql_regcmp()) + """SELECT
  row_number() OVER (ORDER BY week_date, region) - 1 AS row_no, week_date, region, price_spread
FROM rc""",
    "series_rank": W(O.FX_FUEL, O.FX_MANY, MANY_SPREAD) + f"""SELECT *,
  1 + (SELECT count(*) FROM g o WHERE o.avg_spread_pct > g.avg_spread_pct
       OR (g.avg_spread_pct IS NULL AND o.avg_spread_pct IS NOT NULL)) AS spread_rank
FROM g""".replace("SELECT *,", f""", g AS (SELECT series, {R('avg(price_spread_pct)')} AS avg_spread_pct,
    min(price_spread_pct) AS min_spread_pct, max(price_spread_pct) AS max_spread_pct,
    count(price_spread_pct) AS n_weeks FROM rm GROUP BY series)
SELECT *,""", 1),
    "price_box": f"""WITH q AS (
  SELECT o_orderpriority, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
    quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
    quantile_cont(o_totalprice, 0.75) AS q3
  FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1)
SELECT o_orderpriority, n, {R('lo')} AS min_value, {R('q1')} AS q1, {R('median')} AS median,
  {R('q3')} AS q3, {R('hi')} AS max_value, {R('q3 - q1')} AS iqr,
  {R('q1 - 1.5 * (q3 - q1)')} AS lower_fence, {R('q3 + 1.5 * (q3 - q1)')} AS upper_fence,
  (SELECT count(*) FROM orders o WHERE o.o_orderpriority = q.o_orderpriority AND (
    o.o_totalprice < q1 - 1.5 * (q3 - q1) OR o.o_totalprice > q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM q""",
    "events_rolling": f"""SELECT event_id, event_type, value,
  {R('avg(value) OVER (w ROWS BETWEEN 51 PRECEDING AND CURRENT ROW)')} AS mean_52,
  {R('stddev_samp(value) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)')} AS sd_12,
  {R('value - lag(value) OVER w')} AS change, {R('max(value) OVER w')} AS highest
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)""",
}
SQL |= CF.sql(sql_metrics)
