import datetime as dt

import pytest

from tidemark.plans import history as H
from tidemark.plans.upsert import DuplicateKeyError, keyed_upsert
from tests.conftest import rows

SCHEMA = "week_date date, region string, price double, load_ts timestamp_ntz"
T0 = dt.datetime(2026, 1, 5)
D = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(6)]


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_upsert_cases(spark):
    target = table(spark, [(D[0], "US", 1.0, T0), (D[1], "US", 2.0, T0), (D[2], "US", 3.0, T0)])
    batch = table(spark, [(D[1], "US", 2.5, None),    # matched: overwritten
                          (D[2], "US", None, None),   # matched with NULL: NULL wins
                          (D[3], "US", 4.0, None)])   # new key: inserted
    out = keyed_upsert(target, batch, ["week_date", "region"], run_ts="2026-01-12 00:00:00")
    t1 = dt.datetime(2026, 1, 12)
    assert rows(out) == [(D[0], "US", 1.0, T0), (D[1], "US", 2.5, t1),
                         (D[2], "US", None, t1), (D[3], "US", 4.0, t1)]
    # same batch twice = once
    again = keyed_upsert(out, batch, ["week_date", "region"], run_ts="2026-01-12 00:00:00")
    assert rows(again) == rows(out)


def test_upsert_empty_batch_is_noop(spark):
    target = table(spark, [(D[0], "US", 1.0, T0)])
    out = keyed_upsert(target, table(spark, []), ["week_date", "region"], run_ts="2026-01-12")
    assert rows(out) == rows(target)


def test_upsert_duplicates(spark):
    target = table(spark, [(D[0], "US", 1.0, T0)])
    batch = spark.createDataFrame([(D[0], "US", 5.0, None, 1), (D[0], "US", None, None, 2)],
                                  SCHEMA + ", ord int")
    with pytest.raises(DuplicateKeyError):
        keyed_upsert(target, batch.drop("ord"), ["week_date", "region"])
    out = keyed_upsert(target, batch, ["week_date", "region"], on_duplicate="last",
                       order_col="ord", run_ts="2026-01-12")
    assert rows(out, "price") == [(None,)]


def test_upsert_null_keys_never_match(spark):
    target = table(spark, [(None, "US", 1.0, T0)])
    out = keyed_upsert(target, table(spark, [(None, "US", 2.0, None)]), ["week_date", "region"],
                       on_duplicate="assume_unique")
    assert len(out.collect()) == 2


def _run(hist, spark, data, run_ts):
    return H.snapshot(hist, table(spark, data), ["week_date", "region"], run_ts=run_ts)


def test_history_four_runs(spark):
    t = [dt.datetime(2026, 1, 5 + 7 * i) for i in range(4)]
    # run 1: insert two keys
    h = _run(None, spark, [(D[0], "US", 1.0, t[0]), (D[1], "US", 2.0, t[0])], t[0])
    # run 2: key 0 changes (newer load time), key 1 unchanged (equal load time)
    h = _run(h, spark, [(D[0], "US", 1.5, t[1]), (D[1], "US", 2.0, t[0])], t[1])
    # run 3: key 1 deleted from the source
    h = _run(h, spark, [(D[0], "US", 1.5, t[1])], t[2])
    # run 4: key 1 returns
    h = _run(h, spark, [(D[0], "US", 1.5, t[1]), (D[1], "US", 2.2, t[3])], t[3])
    got = rows(h, "week_date", "price", "valid_from", "valid_to")
    assert got == [
        (D[0], 1.0, t[0], t[1]), (D[0], 1.5, t[1], None),
        (D[1], 2.0, t[0], t[2]), (D[1], 2.2, t[3], None)]
    ids = [r["scd_id"] for r in h.collect()]
    assert len(set(ids)) == len(ids)
    # at most one current version per key
    cur = H.current_rows(h).groupBy("week_date").count().collect()
    assert all(r["count"] == 1 for r in cur)
    # as-of reads
    assert rows(H.as_of(h, t[0]), "week_date", "price") == [(D[0], 1.0), (D[1], 2.0)]
    assert rows(H.as_of(h, t[2]), "week_date", "price") == [(D[0], 1.5)]


def test_history_scd_id_matches_sql_text(spark):
    h = _run(None, spark, [(D[0], "US", 1.0, T0)], T0)
    import hashlib
    expect = hashlib.md5(f"{D[0]}|US|2026-01-05 00:00:00".encode()).hexdigest()
    assert h.first()["scd_id"] == expect


def test_history_check_strategy(spark):
    t = [dt.datetime(2026, 1, 5 + 7 * i) for i in range(3)]
    run = lambda h, data, ts: H.snapshot(h, table(spark, data), ["week_date", "region"],
                                         run_ts=ts, strategy="check")
    h = run(None, [(D[0], "US", 1.0, t[0]), (D[1], "US", None, t[0])], t[0])
    # new load time, same values (NULL = NULL): no new version under "check"
    h = run(h, [(D[0], "US", 1.0, t[1]), (D[1], "US", None, t[1])], t[1])
    assert h.count() == 2
    # a value change starts a version at the snapshot time
    h = run(h, [(D[0], "US", 1.1, t[2]), (D[1], "US", None, t[2])], t[2])
    got = rows(h, "week_date", "price", "valid_from", "valid_to")
    assert got == [(D[0], 1.0, t[0], t[2]), (D[0], 1.1, t[2], None), (D[1], None, t[0], None)]


def test_history_table_form_matches_in_memory(spark, workdir):
    import os
    t = [dt.datetime(2026, 1, 5 + 7 * i) for i in range(4)]
    ts = [x.strftime("%Y-%m-%d %H:%M:%S") for x in t]
    runs = [
        [(D[0], "US", 1.0, t[0]), (D[1], "US", 2.0, t[0])],
        [(D[0], "US", 1.5, t[1]), (D[1], "US", 2.0, t[0])],
        [(D[0], "US", 1.5, t[1])],
        [(D[0], "US", 1.5, t[1]), (D[1], "US", 2.2, t[3])],
    ]
    hdir = os.path.join(workdir, "hist")
    mem = None
    for data, run in zip(runs, ts):
        H.snapshot_table(spark, hdir, table(spark, data), ["week_date", "region"], run_ts=run)
        mem = H.snapshot(mem, table(spark, data), ["week_date", "region"], run_ts=run)
    got = H.read_history(spark, hdir)
    assert rows(got, *mem.columns) == rows(mem)
    # closed versions live in per-run folders that later runs never rewrite
    assert sorted(os.listdir(os.path.join(hdir, "closed"))) == [
        "run=20260105000000", "run=20260112000000", "run=20260119000000",
        "run=20260126000000"]


def test_history_table_rerun_is_noop(spark, workdir):
    import os
    hdir = os.path.join(workdir, "hist")
    r1 = [(D[0], "US", 1.0, T0), (D[1], "US", 2.0, T0)]
    r2 = [(D[0], "US", 1.0, T0)]                       # key 1 deleted
    assert H.snapshot_table(spark, hdir, table(spark, r1), ["week_date", "region"],
                            run_ts="2026-01-05 00:00:00")
    assert H.snapshot_table(spark, hdir, table(spark, r2), ["week_date", "region"],
                            run_ts="2026-01-12 00:00:00")
    before = rows(H.read_history(spark, hdir))
    assert not H.snapshot_table(spark, hdir, table(spark, r2), ["week_date", "region"],
                                run_ts="2026-01-12 00:00:00")
    assert rows(H.read_history(spark, hdir)) == before and len(before) == 2


def test_history_survives_a_crash_in_any_write(spark, workdir, monkeypatch):
    """Fault injection: the run dies before its marker; readers and the retry see
    the last finished run, so unchanged keys keep their start."""
    import os
    import pytest
    hdir = os.path.join(workdir, "hist")
    keys = ["week_date", "region"]
    r1 = [(D[0], "US", 1.0, T0), (D[1], "US", 2.0, T0)]
    r2 = [(D[0], "US", 1.0, T0)]
    H.snapshot_table(spark, hdir, table(spark, r1), keys, run_ts="2026-01-05 00:00:00")
    before = rows(H.read_history(spark, hdir))
    real = H.create_once
    monkeypatch.setattr(H, "create_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        H.snapshot_table(spark, hdir, table(spark, r2), keys, run_ts="2026-01-12 00:00:00")
    assert rows(H.read_history(spark, hdir)) == before
    monkeypatch.setattr(H, "create_once", real)
    assert H.snapshot_table(spark, hdir, table(spark, r2), keys, run_ts="2026-01-12 00:00:00")
    got = H.read_history(spark, hdir)
    expected = H.snapshot(H.initial_history(table(spark, r1), keys), table(spark, r2), keys,
                          run_ts="2026-01-12 00:00:00")
    assert rows(got, *expected.columns) == rows(expected)


def test_history_survives_a_dead_writers_marker(spark, workdir):
    """An empty run marker is no finished run: the last one stays whole and the retry counts."""
    import os
    hdir, keys = os.path.join(workdir, "hist"), ["week_date", "region"]
    r1 = [(D[0], "US", 1.0, T0), (D[1], "US", 2.0, T0)]
    r2 = [(D[0], "US", 1.0, T0)]
    H.snapshot_table(spark, hdir, table(spark, r1), keys, run_ts="2026-01-05 00:00:00")
    open(os.path.join(hdir, "_runs", "20260112000000"), "w").close()
    assert H.read_history(spark, hdir).count() == 2
    assert H.snapshot_table(spark, hdir, table(spark, r2), keys, run_ts="2026-01-12 00:00:00")
    expected = H.snapshot(H.initial_history(table(spark, r1), keys), table(spark, r2), keys,
                          run_ts="2026-01-12 00:00:00")
    assert rows(H.read_history(spark, hdir), *expected.columns) == rows(expected)


def test_history_run_overtaken_by_another_writer(spark, workdir, monkeypatch):
    """Another writer finishes the same run first: ours raises, nothing is deleted."""
    import os
    import pytest
    hdir, keys = os.path.join(workdir, "hist"), ["week_date", "region"]
    r1 = [(D[0], "US", 1.0, T0), (D[1], "US", 2.0, T0)]
    H.snapshot_table(spark, hdir, table(spark, r1), keys, run_ts="2026-01-05 00:00:00")
    monkeypatch.setattr(H, "create_once", lambda *a: False)
    with pytest.raises(H.ConcurrentWrite):
        H.snapshot_table(spark, hdir, table(spark, r1[:1]), keys, run_ts="2026-01-12 00:00:00")
    assert H.read_history(spark, hdir).count() == 2
