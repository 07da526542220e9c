import duckdb
import pytest

import __spark_entry__ as entry
from tests.llm.conftest import odd_rows, rows
from tests.llm.test_secrets import TEXTS
from tidemark.llm import queries
from pyspark.sql import functions as F
from tidemark.llm import secrets


def test_every_query_is_registered():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert "pipeline" in names and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_duckdb(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    got = rows(df)
    res = con.execute(queries.SQL[name])
    names = [d[0] for d in res.description]
    order = [names.index(c) for c in df.columns]
    expected = [tuple(r[i] for i in order) for r in res.fetchall()]
    assert got == sorted(expected, key=lambda r: [(x is None, str(x)) for x in r])


def test_secret_sql_on_odd_texts(frame):
    texts = list(enumerate(TEXTS)) + [(100 + i, r[1]) for i, r in enumerate(odd_rows())]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", texts)
    sql = dict(con.execute("SELECT doc_id, spans FROM (" + queries.SQL["op10_secret_scan"]
                           + ")").fetchall())
    own = secrets.scan(frame(texts)).select(F.col("row.doc_id"), secrets.joined(F.col("spans")))
    assert sql == {r[0]: r[1] for r in own.collect()}
    assert any("entropy" in s for s in sql.values())
