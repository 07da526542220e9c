import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import rows
from tidemark.operators import checks as CK
from tidemark.operators import reports as RP
from tidemark.plans import ordering as OR

SF = "/root/testdata/sf0.01"


def table(spark, n=600, seed=2):
    rng = random.Random(seed)
    data = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), i,
             None if rng.random() < 0.1 else round(rng.gauss(0, 3), 1)) for i in range(n)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, t int, v double").repartition(6)


def test_running_total_matches_a_window(spark):
    df = table(spark).withColumn("w", F.col("t") % 5)
    got = OR.running_total(df, ["g"], ["t"], weight="w", partitions=7)
    w = Window.partitionBy("g").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    assert rows(got) == rows(df.withColumn("before", F.coalesce(F.sum("w").over(w), F.lit(0))))
    pos = OR.running_total(df, [], ["t"], name="pos", partitions=5)
    assert sorted(r["pos"] for r in pos.collect()) == list(range(600))
    assert OR.running_total(df.limit(0), ["g"], ["t"]).count() == 0


def test_exact_quartiles(spark):
    df = table(spark).unionByName(spark.createDataFrame([("one", 1, 5.0), ("none", 1, None)],
                                                        "g string, t int, v double"))
    got = {r["g"]: r for r in RP.box_stats_unbounded(df, group_col="g", value_col="v").collect()}
    assert "none" not in got and got["one"]["median"] == got["one"]["q1"] == 5.0
    for r in df.filter("v IS NOT NULL").groupBy("g").agg(
            F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
            F.count("v").alias("n"), F.sort_array(F.collect_list("v")).alias("all")).collect():
        own = got[r["g"]]
        assert [own["q1"], own["median"], own["q3"]] == pytest.approx(r["q"], abs=1e-4)
        assert own["n"] == r["n"] and own["min_value"] == r["all"][0]
        low, high = r["q"][0] - 1.5 * (r["q"][2] - r["q"][0]), r["q"][2] + 1.5 * (r["q"][2] - r["q"][0])
        assert own["n_outliers"] == sum(not low <= v <= high for v in r["all"])


def test_exact_quartiles_keep_no_group_together(spark):
    q, _ = OR.exact_quantiles(table(spark), "g", "v", {"median": 0.5})
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in p and "collect_" not in p


@pytest.mark.parametrize("descending", [True, False])
def test_ranks_with_ties(spark, descending):
    df = table(spark, 200).select("t", "v")  # one decimal place: many ties, and NULLs
    got = {r["t"]: r["rank"] for r in OR.ranked(df, "v", descending=descending).collect()}
    order = F.desc_nulls_last("v") if descending else F.asc_nulls_last("v")
    for r in df.withColumn("rank", F.rank().over(Window.orderBy(order))).collect():
        assert got[r["t"]] == r["rank"]


def test_ranking_has_no_one_task_window(spark):
    df = RP.series_ranking(table(spark).withColumnsRenamed({"g": "region", "v": "price_spread_pct"}))
    p = df._jdf.queryExecution().executedPlan().toString()
    # Only the totals of the partitions, one row each, come together.
    assert len(re.findall("SinglePartition", p)) == len(re.findall(
        r"Exchange SinglePartition.*\n[ :+-]*HashAggregate\(keys=\[_part", p))
    assert rows(df) == rows(RP.region_ranking(
        table(spark).withColumnsRenamed({"g": "region", "v": "price_spread_pct"})).withColumn(
        "spread_rank", F.col("spread_rank").cast("long")))


def test_chunks_equal_plain_windows(spark):
    df = table(spark, 900)
    windows = {"mean": lambda w: F.avg("v").over(w.rowsBetween(-11, 0)),
               "sd": lambda w: F.stddev_samp("v").over(w.rowsBetween(-4, 0)),
               "step": lambda w: F.col("v") - F.lag("v", 1).over(w)}
    got = OR.chunked(df, ["g"], "t", rows_before=11, chunk=50, windows=windows,
                     running={"high": ("max", "v"), "low": ("min", "v"), "total": ("sum", "v")})
    w = Window.partitionBy("g").orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("*", *(make(w).alias(n) for n, make in windows.items()),
                      F.max("v").over(upto).alias("high"), F.min("v").over(upto).alias("low"),
                      F.sum("v").over(upto).alias("total"))

    def rounded(x):
        return rows(x.select("g", "t", "v", *(F.round(c, 6).alias(c) for c in (
            "mean", "sd", "step", "high", "low", "total"))))

    assert rounded(got) == rounded(plain)
    with pytest.raises(ValueError):
        OR.chunked(df, ["g"], "t", rows_before=11, chunk=5, windows=windows)


def test_no_task_sees_the_whole_series(spark):
    """The window's partitions are chunks: none has more rows than a chunk and its halo."""
    df = spark.range(5000).select(F.lit("s").alias("g"), F.col("id").alias("t"), F.rand(1).alias("v"))
    got = OR.chunked(df, ["g"], "t", rows_before=3, chunk=100,
                     windows={"n": lambda w: F.count("v").over(w.rowsBetween(
                         Window.unboundedPreceding, Window.unboundedFollowing))})
    assert got.agg(F.max("n")).first()[0] == 103


def test_files_in_order_are_ordered(spark, workdir):
    import os

    import pyarrow.parquet as pq
    df = table(spark, 1000).filter("g IS NOT NULL")
    OR.write_ordered(df, f"{workdir}/t", ["g", "t"], files=6)
    parts = sorted(f for f in os.listdir(f"{workdir}/t") if f.endswith(".parquet"))
    read = [(r["g"], r["t"]) for f in parts for r in pq.read_table(f"{workdir}/t/{f}").to_pylist()]
    assert len(parts) > 2 and read == sorted(read) and len(read) == df.count()


def test_suite_scans_each_table_once(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    chs = [*CK.not_null("o", "o_orderkey", "o_custkey", "o_totalprice"),
           CK.accepted_values("o", "o_orderstatus", ["F", "O"]),
           CK.accepted_values("o", "o_orderpriority", ["1-URGENT", "2-HIGH"])]
    df = CK.run_checks({"o": orders}, chs)
    got = rows(df, "column_name", "failures")
    assert got == [("o_custkey", 0), ("o_orderkey", 0), ("o_orderpriority", 3),
                   ("o_orderstatus", 1), ("o_totalprice", 0)]
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", p)) == 1 and "Expand" not in p


def test_check_suite_builds_each_table_once(spark):
    """One scan per base table that a published table is made of, whatever its checks."""
    p = entry.queries()["check_suite"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    both = entry.queries()["report_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", p)) <= len(re.findall("FileScan parquet", both))
