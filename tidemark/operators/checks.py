"""Declarative table checks.

``not_null``: failures = rows where the column is NULL.
``accepted_values``: failures = distinct non-NULL values outside the list
(NULL passes, as with ``NOT IN`` in SQL).

All checks of a table run in one scan of it. A scan keeps only rows that break some
check (the condition reaches the Parquet reader, so row groups without such rows are
skipped), makes one row of each broken check, and combines equal ones before the one
shuffle that all tables share: a clean table sends nothing, and a bad value in a third
of all rows is one row a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_NULL = "not_null"
ACCEPTED = "accepted_values"


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    test: str
    values: tuple = field(default=())


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, c, NOT_NULL) for c in columns]


def accepted_values(table: str, column: str, values: Sequence) -> Check:
    return Check(table, column, ACCEPTED, tuple(values))


def _broken(check: Check):
    c = F.col(check.column)
    if check.test == NOT_NULL:
        return c.isNull()
    if check.test == ACCEPTED:
        return ~c.isin(list(check.values))  # NULL for a NULL value: not broken
    raise ValueError(f"unknown test {check.test!r}")


def _failures(table: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """``(check, value)`` for every broken check of every row of ``table``."""
    any_, marks = None, []
    for i, ch in checks:
        bad = _broken(ch)
        any_ = bad if any_ is None else any_ | bad
        value = F.col(ch.column).cast("string") if ch.test == ACCEPTED else F.lit(None).cast("string")
        marks.append(F.when(bad, F.struct(F.lit(i).alias("check"), value.alias("value"))))
    # array_compact leaves the broken ones.
    return table.filter(any_).select(F.inline(F.array_compact(F.array(*marks))))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: table_name, column_name, test_name, failures, status."""
    by_table: dict[str, list[tuple[int, Check]]] = {}
    for i, ch in enumerate(checks):
        by_table.setdefault(ch.table, []).append((i, ch))
    found = None
    for name, own in by_table.items():
        part = _failures(tables[name], own)
        found = part if found is None else found.unionByName(part)
    distinct = [i for i, ch in enumerate(checks) if ch.test == ACCEPTED]
    counted = found.groupBy("check", "value").count()
    failures = counted.groupBy("check").agg(
        F.when(F.col("check").isin(distinct), F.count("value")).otherwise(F.sum("count"))
        .alias("failures"))
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame(
        [(i, ch.table, ch.column, ch.test) for i, ch in enumerate(checks)],
        "check int, table_name string, column_name string, test_name string")
    out = listed.join(failures, "check", "left").select(
        "table_name", "column_name", "test_name",
        F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("PASS"))
                                     .otherwise(F.lit("FAIL")))
