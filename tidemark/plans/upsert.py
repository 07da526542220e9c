"""Keyed upsert (B2a-c) and typed staging.

The loads overwrite *every* non-key column of a matched row (NULL included)
and stamp the load time on matched and inserted rows alike. So the merged
table is exactly

    target rows whose key is not in the batch   UNION ALL   the batch

which needs no full outer join: a left-anti join removes the replaced keys
and the batch is appended. A batch is normally a small staged table (see
:func:`tidemark.plans.publish.load`, which writes the stage first): Catalyst
then broadcasts its key set from file statistics and the target is filtered
map-side without a shuffle; a large batch gets a shuffled anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



class DuplicateKeyError(ValueError):
    """Raised by ``on_duplicate="error"`` when a batch repeats a key."""


def dedupe_last(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_col`` (later wins).

    ``max_by`` over a struct of the row is a partial aggregate: a key that
    repeats millions of times is reduced map-side before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    picked = df.groupBy(*keys).agg(F.max_by(row, F.col(order_col)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]) \
                 .select(*df.columns)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise DuplicateKeyError(f"batch has repeated keys on {list(keys)}")


def stage(batch: DataFrame, schema, *, run_ts, load_ts_col: str = "load_ts",
          defaults: dict | None = None) -> DataFrame:
    """Typed stage: cast the batch to the table schema, fill constant columns
    (B7) and stamp the load time (an argument, so runs are repeatable)."""
    defaults = dict(defaults or {})
    cols = []
    for f in schema.fields:
        if f.name == load_ts_col:
            ts = F.lit(run_ts) if run_ts is not None else F.current_timestamp()
            cols.append(ts.cast(f.dataType).alias(f.name))
        elif f.name in batch.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return batch.select(*cols)


def keyed_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], *,
                 run_ts=None, load_ts_col: str | None = "load_ts",
                 on_duplicate: str = "error", order_col: str | None = None) -> DataFrame:
    """MERGE-equivalent upsert of ``batch`` into ``target`` on ``keys``.

    * matched keys: every non-key column comes from the batch (NULL too);
    * new keys: inserted;
    * target keys absent from the batch: kept unchanged;
    * ``load_ts`` of matched and inserted rows = ``run_ts`` (if given);
    * NULL keys never match (plain equality), as in SQL MERGE;
    * repeated batch keys: ``on_duplicate="error"`` raises, ``"last"``
      keeps the row with the greatest ``order_col``; ``"assume_unique"``
      skips the check for batches unique by construction (a GROUP BY key).

    Empty batch: the result is the target unchanged (no-op load).
    """
    keys = list(keys)
    if on_duplicate == "last":
        if order_col is None:
            raise ValueError("on_duplicate='last' needs order_col")
        batch = dedupe_last(batch, keys, order_col)
    elif on_duplicate == "error":
        assert_unique(batch, keys)
    elif on_duplicate != "assume_unique":
        raise ValueError("on_duplicate must be 'error', 'last' or 'assume_unique'")
    cols = target.columns
    src = batch
    if run_ts is not None and load_ts_col is not None:
        ts_type = dict(target.dtypes).get(load_ts_col, "timestamp_ntz")
        src = src.withColumn(load_ts_col, F.lit(run_ts).cast(ts_type))
    src = src.select(*[F.col(c).cast(t) for c, t in target.dtypes])
    kept = target.join(src.select(*keys), on=keys, how="left_anti")
    return kept.select(*cols).unionByName(src)
