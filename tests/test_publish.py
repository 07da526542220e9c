import datetime as dt
import os

import pytest

from tidemark.plans import publish as P
from tidemark.plans.publish import committed_versions, publish, read_version
from tidemark.schemas import NATIONAL
from tests.conftest import rows


def test_versions_and_uncommitted_folder(spark, workdir):
    t = os.path.join(workdir, "tbl")
    assert read_version(spark, t) is None
    v0 = publish(spark.range(3), t)
    v1 = publish(spark.range(5), t)
    assert (v0, v1) == (0, 1) and committed_versions(spark, t) == [0, 1]
    # a crashed write leaves a data folder that no version names: invisible
    spark.range(9).write.parquet(os.path.join(t, "data", "crashed"))
    assert read_version(spark, t).count() == 5
    assert publish(spark.range(7), t) == 2 and read_version(spark, t).count() == 7
    assert read_version(spark, t, 0).count() == 3


def test_a_committed_version_is_never_overwritten(spark, workdir):
    t = os.path.join(workdir, "tbl")
    publish(spark.range(3), t)
    with pytest.raises(P.ConcurrentWrite):
        publish(spark.range(8), t, version=0)
    assert read_version(spark, t).count() == 3
    assert len(os.listdir(os.path.join(t, "data"))) == 1       # the loser's files are gone


def _row(spark, day, price):
    return spark.createDataFrame(
        [(dt.date(2024, 1, day), "US", price, None, None, None, "u", "s", None)], NATIONAL)


def test_two_loads_from_one_version(spark, workdir, monkeypatch):
    """The slower writer fails as a whole; a second try keeps both batches."""
    t = os.path.join(workdir, "nat")
    keys, empty = ["week_date", "region"], spark.createDataFrame([], NATIONAL)
    assert P.load(t, _row(spark, 1, 1.0), keys, initial=empty) == 0
    real, state = P.publish, {"first": True}

    def overtaken(df, table_dir, **kw):
        if state.pop("first", False):
            assert P.load(t, _row(spark, 8, 2.0), keys) == 1
        return real(df, table_dir, **kw)

    monkeypatch.setattr(P, "publish", overtaken)
    with pytest.raises(P.ConcurrentWrite):
        P.load(t, _row(spark, 15, 3.0), keys)
    assert rows(read_version(spark, t), "regular") == [(1.0,), (2.0,)]
    assert P.load(t, _row(spark, 15, 3.0), keys) == 2
    assert rows(read_version(spark, t), "regular") == [(1.0,), (2.0,), (3.0,)]


def test_repeated_run_does_not_append_twice(spark, workdir):
    t = os.path.join(workdir, "log")
    for run in ("2026-01-05 00:00:00", "2026-01-12 00:00:00", "2026-01-12 00:00:00"):
        P.append_run(spark.range(3), t, run)
    assert spark.read.parquet(t).count() == 6


def test_load_empty_is_noop_and_failure_keeps_version(spark, workdir):
    from tidemark.plans.publish import load
    t = os.path.join(workdir, "nat")
    empty = spark.createDataFrame([], NATIONAL)
    assert load(t, empty, ["week_date", "region"], initial=empty) is None
    batch = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "US", 3.1, None, None, None, "u", "s", None)], NATIONAL)
    assert load(t, batch, ["week_date", "region"], run_ts="2026-01-05", initial=empty) == 0
    assert load(t, empty, ["week_date", "region"]) == 0          # no new version
    dup = batch.unionByName(batch)
    with pytest.raises(Exception):
        load(t, dup, ["week_date", "region"])                      # repeated key: abort
    assert committed_versions(spark, t) == [0]
    assert read_version(spark, t).count() == 1


def test_a_writer_that_died_blocks_nobody(spark, workdir):
    """An empty version file is no version and keeps no number; nor does a half-made one."""
    t = os.path.join(workdir, "tbl")
    publish(spark.range(3), t)
    open(os.path.join(t, "_versions", "1"), "w").close()
    open(os.path.join(t, "_versions", ".half"), "w").close()
    assert committed_versions(spark, t) == [0]
    assert publish(spark.range(4), t) == 1 and publish(spark.range(5), t) == 2
    assert [read_version(spark, t, n).count() for n in range(3)] == [3, 4, 5]
    assert not [f for f in os.listdir(os.path.join(t, "_versions"))
                if f.startswith(".") and not f.endswith(".crc") and f != ".half"]


def test_version_file_appears_whole(spark, workdir, monkeypatch):
    """A writer that dies while it writes the marker leaves no version."""
    t = os.path.join(workdir, "tbl")
    publish(spark.range(3), t)
    real = P._fs

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def create(self, *a):
            self.fs.create(*a).close()  # an empty file, then the writer is gone
            raise OSError("lost")

    monkeypatch.setattr(P, "_fs", lambda s, p: (lambda x: (Broken(x[0]), *x[1:]))(real(s, p)))
    with pytest.raises(OSError):
        publish(spark.range(9), t)
    monkeypatch.setattr(P, "_fs", real)
    assert committed_versions(spark, t) == [0] and read_version(spark, t).count() == 3
    assert publish(spark.range(4), t) == 1


def test_run_names_keep_apart(spark, workdir):
    t = os.path.join(workdir, "log")
    for run, n in (("r-1", 2), ("r1", 1), ("r/1 ä", 3), ("r-1", 4)):
        P.append_run(spark.range(n), t, run)
    P.append_run(spark.range(5), t)
    P.append_run(spark.range(6), t)
    got = spark.read.parquet(t)
    assert {(r["run"], r["count"]) for r in got.groupBy("run").count().collect()} == {
        ("r-1", 4), ("r1", 1), ("r/1 ä", 3), (None, 11)}


def test_appended_rows_take_the_tables_types(spark, workdir):
    t = os.path.join(workdir, "log")
    P.append_run(spark.createDataFrame([(1, "a")], "n long, s string"), t, "one")
    P.append_run(spark.createDataFrame([("b", 2)], "s string, n int"), t, "two")
    got = spark.read.parquet(t).drop("run")
    assert got.dtypes == [("n", "bigint"), ("s", "string")] and rows(got) == [(1, "a"), (2, "b")]
    for odd in ("n long", "n long, s string, more int"):
        with pytest.raises(ValueError):
            P.append_run(spark.createDataFrame([], odd), t, "three")
    with pytest.raises(Exception):  # a value that does not fit is no NULL
        P.append_run(spark.createDataFrame([("x", "c")], "n string, s string"), t, "four")
    assert spark.read.parquet(t).count() == 2


def test_old_versions_go(spark, workdir):
    t = os.path.join(workdir, "tbl")
    for n in range(4):
        publish(spark.range(n), t)
    assert P.drop_old_versions(spark, t, keep=2) == [0, 1]
    assert committed_versions(spark, t) == [2, 3] and len(os.listdir(os.path.join(t, "data"))) == 2
    assert publish(spark.range(9), t) == 4 and read_version(spark, t, 2).count() == 2
