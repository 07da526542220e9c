"""Upsert and history against plain-Python statements of their rules."""

import datetime as dt
import random

import pytest

from tidemark.plans import history as H
from tidemark.plans.upsert import keyed_upsert

SCHEMA = "week_date date, region string, price double, load_ts timestamp_ntz"
W0 = dt.date(2024, 1, 1)


def _key(r):
    return (r[0], r[1])


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_upsert_equals_dict_merge(spark, seed):
    rnd = random.Random(seed)
    keys = [(W0 + dt.timedelta(days=7 * i), reg) for i in range(30) for reg in ("A", "B")]
    t0, t1 = dt.datetime(2026, 1, 5), dt.datetime(2026, 1, 12)
    target = [(w, r, rnd.choice([None, round(rnd.uniform(1, 5), 4)]), t0)
              for w, r in rnd.sample(keys, 35)]
    batch = [(w, r, rnd.choice([None, round(rnd.uniform(1, 5), 4)]), None)
             for w, r in rnd.sample(keys, 20)]
    expect = {_key(r): r for r in target}
    for w, r, p, _ in batch:
        expect[(w, r)] = (w, r, p, t1)                 # matched or new: batch wins
    out = keyed_upsert(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA),
                       ["week_date", "region"], run_ts="2026-01-12 00:00:00")
    got = {_key(tuple(r)): tuple(r) for r in out.collect()}
    assert got == expect
    assert out.count() == len(expect)                  # keys stay unique


def _simulate(runs):
    """Timestamp-strategy type-2 history with hard deletes, row by row."""
    hist, current = [], {}
    for run_ts, rows in runs:
        src = {(w, r): (p, ts) for w, r, p, ts in rows}
        for k, (p, ts) in src.items():
            cur = current.get(k)
            if cur is None:
                current[k] = [k, p, ts, None]
            elif ts > cur[2]:
                cur[3] = ts
                hist.append(tuple(cur))
                current[k] = [k, p, ts, None]
        for k in list(current):
            if k not in src:
                cur = current.pop(k)
                cur[3] = run_ts
                hist.append(tuple(cur))
    return sorted(hist + [tuple(v) for v in current.values()], key=repr)


@pytest.mark.parametrize("seed", [21, 22])
def test_snapshot_equals_simulation(spark, seed):
    rnd = random.Random(seed)
    keys = [(W0 + dt.timedelta(days=7 * i), "US") for i in range(12)]
    runs, df_runs = [], []
    for n in range(5):
        run_ts = dt.datetime(2026, 1, 5) + dt.timedelta(days=7 * n)
        rows = []
        for k in rnd.sample(keys, rnd.randint(6, 12)):
            # load time is the run time or an older one (unchanged row)
            ts = run_ts if rnd.random() < 0.6 else dt.datetime(2026, 1, 5)
            rows.append((k[0], k[1], round(rnd.uniform(1, 5), 4), ts))
        runs.append((run_ts, rows))
    hist = None
    for run_ts, rows in runs:
        hist = H.snapshot(hist, spark.createDataFrame(rows, SCHEMA), ["week_date", "region"],
                          run_ts=run_ts.strftime("%Y-%m-%d %H:%M:%S"))
    got = sorted((((r["week_date"], r["region"]), r["price"], r["valid_from"], r["valid_to"])
                  for r in hist.collect()), key=repr)
    assert got == _simulate(runs)
