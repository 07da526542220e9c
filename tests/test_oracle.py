"""Every registered query against its DuckDB twin (the driver's gate, locally).

Runs at sf0.001 by default (set TIDEMARK_ORACLE_SF_DIR for another scale).
"""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TIDEMARK_ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_registry_is_complete():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # every query but those of the optional subpackage has a SQL twin
    own = {n for n in entry.queries() if n in entry.catalog.SPARK}
    assert own <= set(entry.oracle_sql())
    assert len(own) == 65


@pytest.mark.parametrize("name", sorted(entry.catalog.SQL))
def test_query_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(srows, df.columns) == _digest(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "volatility_label" in df.columns
