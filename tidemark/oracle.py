"""DuckDB SQL text for the correctness oracle.

Each query of ``__spark_entry__.queries()`` has an ANSI-SQL twin here that
DuckDB runs over the same Parquet tables (pre-registered as views named after
the tables). The fixture CTEs mirror :mod:`tidemark.sources.fixtures`.
"""

from __future__ import annotations

from tidemark.sources import fixtures as fx


def R(x: str, n: int = 4) -> str:
    """Half-away-from-zero rounding through DECIMAL; what does not fit stays, NaN is NULL."""
    return (f"coalesce(try_cast(round(try_cast(({x}) AS decimal(28,10)), {n}) AS double), "
            f"nullif(cast(({x}) AS double), cast('nan' AS double)))")


def MEAN(x: str, where: str | None = None) -> str:
    """Exact decimal sum / count."""
    f = f" FILTER (WHERE {where})" if where else ""
    return f"(cast(sum({x}){f} AS double) / nullif(count({x}){f}, 0))"


def WEEK(x: str) -> str:
    return f"cast(date_trunc('week', {x}) AS date)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


LOAD_TS = f"cast({_q(fx.FIXTURE_LOAD_TS)} AS timestamp)"


def _grade_cols() -> str:
    return ",\n".join(
        f"    {R(MEAN('cast(o_totalprice AS decimal(12,2))', f'o_orderpriority = {_q(p)}') + f' / {fx.PRICE_SCALE}')} AS {g}"
        for g, p in fx.GRADE_PRIORITY.items())


FX_FUEL = f"""fx_fuel AS (
  SELECT {WEEK('o_orderdate')} AS week_date, {_q(fx.NATIONAL_REGION)} AS region,
{_grade_cols()},
    {R(MEAN('cast(o_totalprice AS decimal(12,2))') + f' / {fx.PRICE_SCALE}')} AS all_grades,
    {_q(fx.PRICE_UNIT)} AS price_unit, {_q(fx.NATIONAL_SOURCE)} AS source, {LOAD_TS} AS load_ts
  FROM orders GROUP BY 1
)"""

FX_REGIONAL = f"""fx_regional AS (
  SELECT {WEEK('o.o_orderdate')} AS week_date, r.r_name AS region,
    {R(MEAN('cast(o.o_totalprice AS decimal(12,2))') + f' / {fx.PRICE_SCALE}')} AS price,
    {_q(fx.FUEL_TYPE)} AS fuel_type, {_q(fx.PRICE_UNIT)} AS price_unit,
    {_q(fx.REGIONAL_SOURCE)} AS source, {LOAD_TS} AS load_ts
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2
)"""

FX_MANY = f"""fx_many AS (
  SELECT {WEEK('o.o_orderdate')} AS week_date,
    concat_ws('/', n.n_name, o.o_orderpriority) AS series,
    {R(MEAN('cast(o.o_totalprice AS decimal(12,2))') + f' / {fx.PRICE_SCALE}')} AS price
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2
)"""

_TICKER_CASE = "CASE ticker " + " ".join(
    f"WHEN {_q(k)} THEN {_q(v)}" for k, v in fx.TICKER_NAMES.items()) + " END"

FX_DAILY = f"""fx_daily AS (
  SELECT l_returnflag AS ticker, cast(l_shipdate AS date) AS day,
    {MEAN('cast(l_extendedprice AS decimal(12,2))')} / {fx.BAR_SCALE} AS p, count(*) AS n
  FROM lineitem GROUP BY 1, 2
)"""

FX_MARKET = f"""{FX_DAILY},
fx_market AS (
  SELECT {WEEK('day')} AS week_date, ticker, {_TICKER_CASE} AS ticker_name,
    {R('arg_min(p, day)')} AS open, {R('max(p)')} AS high, {R('min(p)')} AS low,
    {R('arg_max(p, day)')} AS close, cast(sum(n) AS bigint) AS volume, {LOAD_TS} AS load_ts
  FROM fx_daily GROUP BY 1, 2
)"""

FX_POINTS = """fx_points AS (
  SELECT event_type AS series, event_id, ts, cast(cast(ts AS date) AS varchar) AS period,
    json_extract_string(props, '$.k') AS value
  FROM events
)"""




def _cases(column: str, rule: dict, m: int) -> str:
    arms = " ".join(f"WHEN {k} THEN {'NULL' if v is None else _q(v)}" for k, v in rule.items())
    return f"CASE event_id % {m} {arms} ELSE {column} END AS {column}"


FX_POINTS_DIRTY = f"""fx_points_dirty AS (
  SELECT series, event_id, ts, {_cases('period', fx.DIRTY_PERIODS, 19)},
    {_cases('value', fx.DIRTY_VALUES, 17)}
  FROM fx_points
)"""

FX_TICKS_DIRTY = """fx_ticks_dirty AS (
  SELECT ticker, day, CASE WHEN day(day) % 7 <> 0 AND day(day) % 13 <> 0 THEN p END AS p,
    CASE WHEN day(day) % 11 <> 0 THEN n END AS n
  FROM fx_daily
)"""


def _dirty_grades() -> str:
    out = []
    for g, p in fx.GRADE_PRIORITY.items():
        x = R(MEAN("cast(o_totalprice AS decimal(12,2))", f"o_orderpriority = {_q(p)}")
              + f" / {fx.PRICE_SCALE}")
        out.append(f"{x} AS {g}")
    return ", ".join(out)


FX_FUEL_DIRTY = f"""fx_fuel_dirty AS (
  SELECT * REPLACE (CASE WHEN day(week_date) < 29 THEN regular END AS regular) FROM (
    SELECT {WEEK('o_orderdate')} AS week_date,
      CASE WHEN o_orderkey % 17 = 0 THEN {_q(fx.OTHER_REGION)}
           ELSE {_q(fx.NATIONAL_REGION)} END AS region, {_dirty_grades()}
    FROM orders GROUP BY 1, 2)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
