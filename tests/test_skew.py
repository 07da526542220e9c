"""Hot keys: one customer with a third of all orders, map too large to broadcast."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.sources import fixtures as fx
from tests.conftest import rows


def _write_tables(spark, d):
    n_orders, hot = 30000, 7
    orders = spark.range(n_orders).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") % 500).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        (F.col("id") % 1000 * 100.0 + 1000.0).alias("o_totalprice"),
        (F.lit(dt.datetime(1995, 1, 2)).cast("timestamp_ntz")
         + F.make_dt_interval(F.col("id") % 700)).alias("o_orderdate"),
        F.lit("3-MEDIUM").alias("o_orderpriority"))
    customer = spark.range(500).select(
        F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"),
        (F.col("id") % 25).cast("int").alias("c_nationkey"), F.lit(0.0).alias("c_acctbal"),
        F.lit("S").alias("c_mktsegment"))
    nation = spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"),
                                    F.concat(F.lit("N"), F.col("id")).alias("n_name"),
                                    (F.col("id") % 5).cast("int").alias("n_regionkey"))
    region = spark.range(5).select(F.col("id").cast("int").alias("r_regionkey"),
                                   F.concat(F.lit("R"), F.col("id")).alias("r_name"))
    for name, df in [("orders", orders), ("customer", customer), ("nation", nation),
                     ("region", region)]:
        df.coalesce(4).write.parquet(os.path.join(d, f"{name}.parquet"))


def test_hot_customer_shuffle_path_equals_broadcast_path(spark, workdir):
    d = os.path.join(workdir, "skewed")
    _write_tables(spark, d)
    expected = rows(fx.orders_by_nation(spark, d))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = fx.orders_by_nation(spark, d)
        got = rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected
    assert "BroadcastHashJoin [o_custkey" not in plan
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final
