"""Explicit schemas of the published tables (no inference on read)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

NATIONAL = StructType([
    StructField("week_date", DateType(), False),
    StructField("region", StringType(), False),
    StructField("regular", DoubleType()),
    StructField("midgrade", DoubleType()),
    StructField("premium", DoubleType()),
    StructField("diesel", DoubleType()),
    StructField("price_unit", StringType()),
    StructField("source", StringType()),
    StructField("load_ts", TimestampNTZType()),
])
NATIONAL_KEY = ("week_date", "region")

REGIONAL = StructType([
    StructField("week_date", DateType(), False),
    StructField("region", StringType(), False),
    StructField("price", DoubleType()),
    StructField("fuel_type", StringType(), False),
    StructField("price_unit", StringType()),
    StructField("source", StringType()),
    StructField("load_ts", TimestampNTZType()),
])
REGIONAL_KEY = ("week_date", "region", "fuel_type")

MARKET = StructType([
    StructField("week_date", DateType(), False),
    StructField("ticker", StringType(), False),
    StructField("ticker_name", StringType()),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", LongType()),
    StructField("load_ts", TimestampNTZType()),
])
MARKET_KEY = ("week_date", "ticker")

FORECAST = StructType([
    StructField("series", StringType()),
    StructField("ts", TimestampNTZType()),
    StructField("forecast", DoubleType()),
    StructField("lower_bound", DoubleType()),
    StructField("upper_bound", DoubleType()),
])

FINAL = StructType([
    StructField("region", StringType()),
    StructField("week_date", DateType()),
    StructField("actual", DoubleType()),
    StructField("forecast", DoubleType()),
    StructField("lower_bound", DoubleType()),
    StructField("upper_bound", DoubleType()),
    StructField("record_type", StringType()),
])

METRICS = StructType([
    StructField("run_ts", TimestampNTZType()),
    StructField("series", StringType()),
    StructField("error_metric", StringType()),
    StructField("metric_value", DoubleType()),
    StructField("standard_deviation", DoubleType()),
    StructField("logs", StringType()),
])

# Landed API payload: {"response": {"data": [{"period": str, "value": str}]}}
PAYLOAD_POINT = StructType([
    StructField("period", StringType()),
    StructField("value", StringType()),
])
PAYLOAD = StructType([
    StructField("response", StructType([
        StructField("data", ArrayType(PAYLOAD_POINT)),
    ])),
])

# ---- driver tables (read with these schemas: no footer inference per scan) --
from pyspark.sql.types import IntegerType  # noqa: E402

_T = TimestampNTZType
SOURCE_TABLES = {
    "region": StructType([StructField("r_regionkey", IntegerType()),
                          StructField("r_name", StringType())]),
    "nation": StructType([StructField("n_nationkey", IntegerType()),
                          StructField("n_name", StringType()),
                          StructField("n_regionkey", IntegerType())]),
    "customer": StructType([StructField("c_custkey", LongType()),
                            StructField("c_name", StringType()),
                            StructField("c_nationkey", IntegerType()),
                            StructField("c_acctbal", DoubleType()),
                            StructField("c_mktsegment", StringType())]),
    "supplier": StructType([StructField("s_suppkey", LongType()),
                            StructField("s_name", StringType()),
                            StructField("s_nationkey", IntegerType()),
                            StructField("s_acctbal", DoubleType())]),
    "orders": StructType([StructField("o_orderkey", LongType()),
                          StructField("o_custkey", LongType()),
                          StructField("o_orderstatus", StringType()),
                          StructField("o_totalprice", DoubleType()),
                          StructField("o_orderdate", _T()),
                          StructField("o_orderpriority", StringType())]),
    "lineitem": StructType([StructField("l_orderkey", LongType()),
                            StructField("l_partkey", LongType()),
                            StructField("l_suppkey", LongType()),
                            StructField("l_linenumber", IntegerType()),
                            StructField("l_quantity", DoubleType()),
                            StructField("l_extendedprice", DoubleType()),
                            StructField("l_discount", DoubleType()),
                            StructField("l_tax", DoubleType()),
                            StructField("l_returnflag", StringType()),
                            StructField("l_linestatus", StringType()),
                            StructField("l_shipdate", _T())]),
    "events": StructType([StructField("event_id", LongType()),
                          StructField("ts", _T()),
                          StructField("user_id", LongType()),
                          StructField("event_type", StringType()),
                          StructField("value", DoubleType()),
                          StructField("props", StringType())]),
}
