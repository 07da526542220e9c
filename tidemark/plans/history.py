"""Type-2 history (B8) and its current / as-of reads.

A history row carries the source columns plus

    scd_id      md5 of key and update time (same text in Spark and DuckDB)
    updated_at  the source row's update time
    valid_from  when this version became current
    valid_to    when it stopped being current (NULL = current)

Timestamp strategy, hard deletes invalidated:

* a key that is new (or came back after a delete) starts a version at its
  ``updated_at``;
* a key whose ``updated_at`` is later than the current version's
  ``valid_from`` closes that version at the new ``updated_at`` and starts a
  new one;
* a current key missing from the source is closed at the snapshot time;
* anything else is unchanged.

Only current versions take part in the join; closed versions pass through
untouched (no shuffle). Keys are unique on both join sides, so no key can
be hot. Each joined row yields one or two output rows via ``inline`` of a
small array, in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.publish import ConcurrentWrite, _fs, create_once

META = ("scd_id", "updated_at", "valid_from", "valid_to")


def scd_id(keys: Sequence[str], updated_at: str) -> Column:
    parts = [F.col(k).cast("string") for k in keys] + [F.col(updated_at).cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def initial_history(source: DataFrame, keys: Sequence[str], *,
                    updated_at: str = "load_ts") -> DataFrame:
    """First snapshot run: every source row is a current version."""
    return source.select(
        *source.columns,
        scd_id(keys, updated_at).alias("scd_id"),
        F.col(updated_at).alias("updated_at"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast(dict(source.dtypes)[updated_at]).alias("valid_to"))


def snapshot(history: DataFrame | None, source: DataFrame, keys: Sequence[str], *,
             updated_at: str = "load_ts", run_ts=None,
             invalidate_hard_deletes: bool = True, strategy: str = "timestamp",
             check_cols: Sequence[str] | None = None) -> DataFrame:
    """One snapshot run of ``source`` into ``history`` (returns the new history).

    ``strategy="timestamp"`` (default) detects change by a later
    ``updated_at``; ``strategy="check"`` compares ``check_cols`` (default:
    every non-key column except ``updated_at``) NULL-safely, and a new or
    changed row's version then starts at the snapshot time.
    """
    keys = list(keys)
    if strategy not in ("timestamp", "check"):
        raise ValueError("strategy must be 'timestamp' or 'check'")
    data_cols = [c for c in source.columns]
    ts_type = dict(source.dtypes)[updated_at]
    run = F.lit(run_ts).cast(ts_type) if run_ts is not None else F.current_timestamp().cast(ts_type)
    if history is None:
        if strategy == "timestamp":
            return initial_history(source, keys, updated_at=updated_at)
        return initial_history(source.withColumn(updated_at, run), keys, updated_at=updated_at)

    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())

    s = source.select(*[F.col(c).alias(f"s_{c}") for c in data_cols],
                      F.lit(True).alias("s_present"))
    c = current.select(*[F.col(x).alias(f"c_{x}") for x in (*data_cols, *META)],
                       F.lit(True).alias("c_present"))
    cond = [F.col(f"s_{k}") == F.col(f"c_{k}") for k in keys]
    j = s.join(c, on=cond, how="full_outer")

    s_in = F.col("s_present").isNotNull()
    c_in = F.col("c_present").isNotNull()
    if strategy == "timestamp":
        newer = s_in & c_in & (F.col(f"s_{updated_at}") > F.col("c_valid_from"))
        start = F.col(f"s_{updated_at}")
    else:
        cols = list(check_cols) if check_cols is not None else [
            c for c in data_cols if c not in keys and c != updated_at]
        changed = F.lit(False)
        for c in cols:
            changed = changed | ~F.col(f"s_{c}").eqNullSafe(F.col(f"c_{c}"))
        newer = s_in & c_in & changed
        start = run

    def version(prefix: str, valid_to: Column) -> Column:
        fields = [F.col(f"{prefix}{x}").alias(x) for x in data_cols]
        if prefix == "s_":
            parts = [F.col(f"s_{k}").cast("string") for k in keys] + [start.cast("string")]
            meta = [F.md5(F.concat_ws("|", *parts)).alias("scd_id"),
                    start.alias("updated_at"), start.alias("valid_from"),
                    valid_to.alias("valid_to")]
        else:
            meta = [F.col("c_scd_id").alias("scd_id"), F.col("c_updated_at").alias("updated_at"),
                    F.col("c_valid_from").alias("valid_from"), valid_to.alias("valid_to")]
        return F.struct(*fields, *meta)

    null_ts = F.lit(None).cast(ts_type)
    deleted_to = run if invalidate_hard_deletes else null_ts
    rows = (
        F.when(s_in & ~c_in, F.array(version("s_", null_ts)))
         .when(newer, F.array(version("c_", start), version("s_", null_ts)))
         .when(~s_in & c_in, F.array(version("c_", deleted_to)))
         .otherwise(F.array(version("c_", null_ts)))
    )
    moved = j.select(F.inline(rows))
    return closed.select(*data_cols, *META).unionByName(moved)


def current_rows(history: DataFrame) -> DataFrame:
    """Current versions only."""
    return history.filter(F.col("valid_to").isNull())


def with_current_flag(history: DataFrame) -> DataFrame:
    """History with the current-record flag derived from ``valid_to``."""
    return history.withColumn("is_current", F.col("valid_to").isNull())


def as_of(history: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts``: valid_from <= ts < valid_to (or open)."""
    t = F.lit(ts).cast(dict(history.dtypes)["valid_from"])
    return history.filter((F.col("valid_from") <= t) &
                          (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


# ------------------------------------------------------------ table form --
def _runs(spark, history_dir: str) -> list[str]:
    """Tags of the finished runs, oldest first."""
    fs, root, _ = _fs(spark, f"{history_dir.rstrip('/')}/_runs")
    if not fs.exists(root):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(root)
                  if st.getLen() > 0 and not st.getPath().getName().startswith("."))


def read_history(spark, history_dir: str) -> DataFrame | None:
    """The whole history of a table-backed snapshot: the open versions of the last
    finished run and the closed ones of all finished runs."""
    runs, root = _runs(spark, history_dir), history_dir.rstrip("/")
    if not runs:
        return None
    current = spark.read.parquet(f"{root}/current/run={runs[-1]}")
    return current.unionByName(
        spark.read.schema(current.schema).parquet(*(f"{root}/closed/run={t}" for t in runs)))


def snapshot_table(spark, history_dir: str, source: DataFrame, keys: Sequence[str], *,
                   run_ts: str, run_tag: str | None = None, **options) -> bool:
    """One snapshot run against a history stored as files, touching only
    current versions. Returns False if this run was already completed.

    Layout: ``current/run=<tag>/`` holds the open versions after a run,
    ``closed/run=<tag>/`` the versions it closed, ``_runs/<tag>`` is made last
    and makes both count (tags sort by time). Nothing that a reader uses is
    overwritten: after a crash the last finished run is still whole, and the
    retry writes the unfinished run's folders anew from it. The open versions
    of the run before are deleted once the new ones count.
    """
    from tidemark.session import staged

    root = history_dir.rstrip("/")
    tag = run_tag or "".join(ch for ch in run_ts if ch.isdigit())
    runs = _runs(spark, history_dir)
    if tag in runs:
        return False
    previous = spark.read.parquet(f"{root}/current/run={runs[-1]}") if runs else None
    out, discard = staged(snapshot(previous, source, keys, run_ts=run_ts, **options),
                          "snapshot-stage")
    is_open = F.col("valid_to").isNull()
    out.filter(~is_open).write.mode("overwrite").parquet(f"{root}/closed/run={tag}")
    out.filter(is_open).write.mode("overwrite").parquet(f"{root}/current/run={tag}")
    discard()
    if not create_once(spark, f"{root}/_runs/{tag}", "done"):
        raise ConcurrentWrite(f"run {tag} of {history_dir} has another writer")
    # The open versions before this run go only when readers see those after it.
    if runs and _runs(spark, history_dir)[-1] == tag:
        fs, path, _ = _fs(spark, f"{root}/current/run={runs[-1]}")
        fs.delete(path, True)
    return True
