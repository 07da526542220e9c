import math

from pyspark.sql import functions as F

from tidemark.functions import guarded_pct_change, label_by_thresholds, nan_to_null, round_half_away


def test_round_half_away_on_ties(spark):
    # four 4-place prices whose mean ends in 5 at the fifth place
    df = spark.createDataFrame([(1.0001,), (1.0002,), (1.0002,), (1.0001,)], "p double")
    mean = df.agg(F.avg("p").alias("m"))
    out = mean.select(round_half_away("m", 4).alias("r")).first()["r"]
    assert out == 1.0002
    neg = spark.createDataFrame([(-2.00005,)], "x double")
    assert neg.select(round_half_away("x", 4)).first()[0] == -2.0001


def test_round_keeps_what_has_no_decimals(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1.23456,), (1e19,)],
                               "x double")
    got = [r[0] for r in df.select(round_half_away("x", 4)).collect()]
    assert got == [None, float("inf"), None, 1.2346, 1e19]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,)], "x double")
    assert [r[0] for r in df.select(nan_to_null("x")).collect()] == [None, 2.0]


def test_guarded_pct_zero_base(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.1, 1.0), (1.0, None), (1.0, -1.0)], "c double, b double")
    got = [r[0] for r in df.select(guarded_pct_change("c", "b", 4)).collect()]
    assert got[0] is None and got[2] is None and got[3] is None
    assert math.isclose(got[1], 10.0)


def test_labels_strict_and_null(spark):
    df = spark.createDataFrame([(0.3,), (0.31,), (0.15,), (None,)], "x double")
    lab = label_by_thresholds("x", [(0.30, "H"), (0.15, "M")], "L")
    assert [r[0] for r in df.select(lab).collect()] == ["M", "H", "L", "L"]
    lab2 = label_by_thresholds("x", [(0.30, "H")], "L", null_label="N")
    assert [r[0] for r in df.select(lab2).collect()][-1] == "N"


def test_staged_tables_are_new_and_discarded(spark):
    from tidemark.session import staged
    a, drop_a = staged(spark.createDataFrame([(1,)], "x int"), "t")
    b, drop_b = staged(spark.createDataFrame([(2,)], "x int"), "t")
    assert [r[0] for r in a.collect()] == [1] and [r[0] for r in b.collect()] == [2]
    files = a.inputFiles()
    drop_a()
    drop_b()
    import os
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_the_callers_time_zone_stays(spark):
    from tidemark.session import tune
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert tune(spark).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        spark.conf.unset("spark.sql.session.timeZone")
        other = spark.newSession()
        other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert tune(other).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
