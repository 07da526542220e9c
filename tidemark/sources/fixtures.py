"""Weekly price tables derived from the driver's TPC-H-like tables.

These stand in for the three raw tables (national grades, regional prices,
market bars) and for landed API payloads. Each fact table is read in as few
passes as possible, and every function returns a lazy plan down to the scans, so
``explain()`` of a query shows all of its work. Every aggregate is partial (map-side
combine), so a hot key (one priority, one return flag) is reduced to one row
per group and map task before any shuffle.

The same definitions exist as SQL text in :mod:`tidemark.oracle` for the
DuckDB comparison; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away
from tidemark.functions.time import week_start
from tidemark.plans.joins import dimension
from tidemark.sources.payload import build_payload_pages
from tidemark.sources.shaping import weekly_bars
from tidemark.sources.tables import read_table

# ---- fixed values -----------------------------------------------------------
# Domain constants of the published raw tables (unit, source tags, national
# region name, regional fuel type).
NATIONAL_REGION = "US_NATIONAL"
OTHER_REGION = "TEST_REGION"   # ours: a second region of the dirty national table
PRICE_UNIT = "USD_PER_GALLON"
NATIONAL_SOURCE = "EIA_WEEKLY"
REGIONAL_SOURCE = "EIA_REGIONAL"
FUEL_TYPE = "REGULAR_GASOLINE"
# Fixture mapping (ours): order priority plays the role of the price grade.
GRADE_PRIORITY = {
    "regular": "3-MEDIUM",
    "midgrade": "2-HIGH",
    "premium": "1-URGENT",
    "diesel": "5-LOW",
}
# Fixture mapping (ours): return flag plays the ticker; flag A is the crude.
TICKER_NAMES = {
    "A": "Crude (flag A)",
    "N": "Energy ETF (flag N)",
    "R": "Gasoline ETF (flag R)",
}
CRUDE_TICKER = "A"
PRICE_SCALE = 100000.0   # o_totalprice -> a price of a few units
BAR_SCALE = 1000.0       # l_extendedprice -> a daily price in tens
PAYLOAD_PAGE = 200       # points per landed payload page (the API page length)
# Fixed load time of the fixture tables (so results are repeatable).
FIXTURE_LOAD_TS = "2026-01-05 00:00:00"
# -----------------------------------------------------------------------------


def load_ts_lit(ts: str = FIXTURE_LOAD_TS):
    return F.lit(ts).cast("timestamp_ntz")


def cents(c):
    """Money as DECIMAL: sums do not depend on the order of the rows, so a value
    on a rounding tie or label limit cannot flip from run to run."""
    return F.col(c).cast("decimal(12,2)")


def mean(c, condition=None):
    """Exact sum / count, of the rows where ``condition`` (default: all)."""
    x = cents(c) if condition is None else F.when(condition, cents(c))
    return F.sum(x).cast("double") / F.count(x)


def _price(avg_expr):
    return round_half_away(avg_expr / F.lit(PRICE_SCALE), 4)


def fuel_weekly(spark: SparkSession, base_dir: str) -> DataFrame:
    """National table: one row per order week, four grades + all_grades."""
    o = read_table(spark, base_dir, "orders", ["o_orderdate", "o_totalprice", "o_orderpriority"])
    grades = [
        _price(mean("o_totalprice", F.col("o_orderpriority") == F.lit(prio))).alias(g)
        for g, prio in GRADE_PRIORITY.items()
    ]
    return (o.groupBy(week_start("o_orderdate").alias("week_date"))
             .agg(*grades, _price(mean("o_totalprice")).alias("all_grades"))
             .select("week_date", F.lit(NATIONAL_REGION).alias("region"),
                     *GRADE_PRIORITY, "all_grades",
                     F.lit(PRICE_UNIT).alias("price_unit"),
                     F.lit(NATIONAL_SOURCE).alias("source"),
                     load_ts_lit().alias("load_ts")))


def _nation_regions(spark: SparkSession, base_dir: str) -> DataFrame:
    """nation -> (nation name, region name): 25 rows by definition."""
    n = read_table(spark, base_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, base_dir, "region", ["r_regionkey", "r_name"])
    return (n.join(dimension(r, "region"), n.n_regionkey == r.r_regionkey)
             .select("n_nationkey", "n_name", "r_name"))


def orders_by_nation(spark: SparkSession, base_dir: str) -> DataFrame:
    """One joined pass over orders: per (order week, customer nation and
    region, order priority) the sum of order prices and the order count.

    The regional table and the nation x priority series re-aggregate this
    small table (at most weeks x 25 x 5 rows), so orders are joined to
    customer once. Orders join the customer *scan*, so Catalyst sizes that
    join from the customer files: broadcast while customer is small,
    otherwise one shuffle join on the customer key, where AQE's skew-join
    handling splits the partition of a customer holding a third of all
    orders into many tasks (its single customer row is replicated to each).
    The 25-row nation map is a fixed-size broadcast and the aggregation is
    partial. Pre-grouping orders per (customer, week) instead would not
    shrink TPC-H-shaped data (a customer rarely orders twice a week) and
    would double the shuffle. The national table does not need customers
    and keeps its own join-free pass.
    """
    o = read_table(spark, base_dir, "orders",
                   ["o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    c = read_table(spark, base_dir, "customer", ["c_custkey", "c_nationkey"])
    nr = dimension(_nation_regions(spark, base_dir), "nation")
    joined = (o.join(c, o.o_custkey == c.c_custkey)
               .join(nr, c.c_nationkey == nr.n_nationkey))
    return (joined.groupBy(week_start("o_orderdate").alias("week_date"), "n_name", "r_name",
                           "o_orderpriority")
                  .agg(F.sum(cents("o_totalprice")).cast("double").alias("s"),
                       F.count(F.lit(1)).alias("n")))


def regional_weekly(spark: SparkSession, base_dir: str) -> DataFrame:
    """Regional table: one row per (order week, customer region)."""
    agg = (orders_by_nation(spark, base_dir)
           .groupBy("week_date", F.col("r_name").alias("region"))
           .agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    return agg.select(
        "week_date", "region",
        round_half_away(F.col("s") / F.col("n") / F.lit(PRICE_SCALE), 4).alias("price"),
        F.lit(FUEL_TYPE).alias("fuel_type"), F.lit(PRICE_UNIT).alias("price_unit"),
        F.lit(REGIONAL_SOURCE).alias("source"), load_ts_lit().alias("load_ts"))


def many_series(spark: SparkSession, base_dir: str) -> DataFrame:
    """125 series: nation x order priority x week (for scale runs)."""
    agg = orders_by_nation(spark, base_dir)
    return agg.select(
        "week_date", F.concat_ws("/", "n_name", "o_orderpriority").alias("series"),
        round_half_away(F.col("s") / F.col("n") / F.lit(PRICE_SCALE), 4).alias("price"))


def daily_lines(spark: SparkSession, base_dir: str) -> DataFrame:
    """One pass over lineitem: per (return flag, line status, ship day) the
    sums of gross and net extended price and the line count.

    Every lineitem-derived table (market bars, their net-price revision, the
    revised national grades) is re-aggregated from this small table, so the
    fact table is scanned once, whatever the mix of queries. Sums and counts
    (not means) keep the re-aggregation exact: a mean over any grouping is
    sum / count.
    """
    li = read_table(spark, base_dir, "lineitem",
                    ["l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice",
                     "l_discount"])
    p, rate = cents("l_extendedprice"), F.col("l_discount").cast("decimal(3,2)")
    return (li.groupBy(F.col("l_returnflag").alias("ticker"),
                       F.col("l_linestatus").alias("status"),
                       F.to_date("l_shipdate").alias("day"))
              .agg(F.sum(p).alias("s_gross"),
                   F.sum(p * (F.lit(1).cast("decimal(3,2)") - rate)).alias("s_net"),
                   F.count(F.lit(1)).alias("n")))


def daily_ticks(spark: SparkSession, base_dir: str) -> DataFrame:
    """Daily mean price (gross and net) and line count per return flag."""
    d = daily_lines(spark, base_dir)
    n = F.sum("n")
    return (d.groupBy("ticker", "day")
             .agg((F.sum("s_gross").cast("double") / n / F.lit(BAR_SCALE)).alias("p"),
                  (F.sum("s_net").cast("double") / n / F.lit(BAR_SCALE)).alias("p_net"),
                  n.alias("n")))


def ticker_name_col(c="ticker"):
    mapping = F.create_map(*[F.lit(x) for kv in TICKER_NAMES.items() for x in kv])
    return mapping[F.col(c)]


def market_weekly(spark: SparkSession, base_dir: str) -> DataFrame:
    """Market table: weekly OHLCV bars per ticker (A7 over daily means)."""
    bars = weekly_bars(daily_ticks(spark, base_dir), key_cols=["ticker"], time_col="day",
                       price_col="p", volume_col="n")
    return bars.select("week_date", "ticker", ticker_name_col().alias("ticker_name"),
                       "open", "high", "low", "close", "volume",
                       load_ts_lit().alias("load_ts"))


def event_points(spark: SparkSession, base_dir: str) -> DataFrame:
    """Series points from the events table: (series, id, ts, period, value text)."""
    e = read_table(spark, base_dir, "events", ["event_id", "ts", "event_type", "props"])
    return e.select(F.col("event_type").alias("series"), "event_id", "ts",
                    F.to_date("ts").cast("string").alias("period"),
                    F.get_json_object("props", "$.k").alias("value"))


def payload_pages(spark: SparkSession, base_dir: str) -> DataFrame:
    """Landed payload documents: one JSON text per (series, page of ids)."""
    pts = event_points(spark, base_dir).withColumn(
        "page", F.floor(F.col("event_id") / F.lit(PAYLOAD_PAGE)))
    return build_payload_pages(pts, series_col="series", page_col="page", order_col="event_id")


# ---- dirty tables ------------------------------------------------------------
# The driver's tables hold no bad value, so these derive some by rules on keys.
def national_dirty(spark: SparkSession, base_dir: str) -> DataFrame:
    """The national table with a second region (order keys divisible by 17) and
    NULL prices in weeks that begin on the 29th or later (the newest one does)."""
    o = read_table(spark, base_dir, "orders",
                   ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    region = F.when(F.col("o_orderkey") % 17 == 0, F.lit(OTHER_REGION)).otherwise(
        F.lit(NATIONAL_REGION))
    out = (o.groupBy(week_start("o_orderdate").alias("week_date"), region.alias("region"))
           .agg(*[_price(mean("o_totalprice", F.col("o_orderpriority") == F.lit(prio))).alias(g)
                  for g, prio in GRADE_PRIORITY.items()]))
    return out.withColumn("regular", F.when(F.dayofmonth("week_date") < 29, F.col("regular")))


def ticks_dirty(spark: SparkSession, base_dir: str) -> DataFrame:
    """Daily prices per return flag with NaN and NULL: a day of the month divisible
    by 7 has no price, one divisible by 11 no volume, one divisible by 13 is NULL."""
    day = F.dayofmonth("day")
    nan = F.lit(float("nan"))
    return daily_ticks(spark, base_dir).select(
        "ticker", "day",
        F.when(day % 7 == 0, nan).when(day % 13 != 0, F.col("p")).alias("p"),
        F.when(day % 11 == 0, nan).otherwise(F.col("n").cast("double")).alias("n"))


#: Values of a dirty point by ``event_id % 17`` and its period by ``event_id % 19``.
DIRTY_VALUES = {0: "x", 1: "", 2: None, 3: "nan", 4: "1e19", 5: "-7.00005", 6: " 3 "}
DIRTY_PERIODS = {0: "", 1: None}


def points_dirty(spark: SparkSession, base_dir: str) -> DataFrame:
    """Points with unparseable, missing and huge values and with empty periods."""
    def replaced(column, rule, m):
        out = F.col(column)
        for k, v in rule.items():
            out = F.when(F.col("event_id") % m == k, F.lit(v).cast("string")).otherwise(out)
        return out.alias(column)

    return event_points(spark, base_dir).select(
        "series", "event_id", "ts", replaced("period", DIRTY_PERIODS, 19),
        replaced("value", DIRTY_VALUES, 17))
