"""Order over whole tables without a task that sees a whole group.

``running_total`` gives every row the sum of weights of the rows before it in its group
(with weight one: its position). Rows are dealt to partitions by sampled ranges of group and
order key and written once, so that their partition numbers stay fixed; each partition's
total by group is one small row, the sums over the partitions before it are added to
running sums inside the partition. A group with a third of all rows spans many partitions;
a task holds one partition of it.

Order keys must be unique in a group: callers with ties count equal values first, which
also bounds what a hot value costs.

On it rest exact quantiles (:func:`exact_quantiles`), ranks (:func:`ranked`) and rolling
windows over series too long for a task (:func:`chunked`). :func:`write_ordered` writes a table
whose files, read in order of their names, are in order (C5); :func:`read_in_order` numbers
its rows by that order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import staged


def running_total(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], *,
                  weight: str | None = None, name: str = "before",
                  partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``weight`` (default: 1 a row) over the rows of the group
    with a smaller order key. ``df`` is evaluated once, when this is called."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    dealt, _ = staged(df.repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id()),
                      "ranges")
    w = F.col(weight) if weight else F.lit(1)
    each = dealt.groupBy(*group_cols, "_part").agg(F.sum(w).alias("_sum"))
    earlier = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row a partition (and group) in it.
    same = ["_part", *group_cols]
    base = each.select(*(F.col(c).alias(f"_base_{c}") for c in same),
                       F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group_cols, "_part").orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum(w).over(inside), F.lit(0)))
    return (local.join(base, [F.col(c).eqNullSafe(F.col(f"_base_{c}")) for c in same])
            .select(*df.columns,
                    (F.col("_local") + F.col("_base")).cast("long").alias(name)))


def exact_quantiles(df: DataFrame, group_col: str, value_col: str,
                    probabilities: Mapping[str, float]) -> tuple[DataFrame, DataFrame]:
    """Exact quantiles of groups of any size, interpolated between neighbours.

    Returns ``(quantiles, counted)``: one row a group with a column for each name in
    ``probabilities``, ``n``, ``min_value`` and ``max_value``; and the counts of distinct values
    (``group_col``, ``value_col``, ``times``, ``before``), from which more can be read
    without another look at ``df``. Only the rows with a wanted rank are picked, so no
    group's values meet in one place. NULL values are left out.
    """
    v = F.col(value_col)
    times = (df.filter(v.isNotNull()).groupBy(group_col, value_col)
             .agg(F.count(F.lit(1)).alias("times")))
    counted = running_total(times, [group_col], [value_col], weight="times")
    totals = counted.groupBy(F.col(group_col).alias("_group")).agg(
        F.sum("times").alias("n"), F.min(v).alias("min_value"), F.max(v).alias("max_value"))
    rows = counted.join(totals, F.col(group_col).eqNullSafe(F.col("_group")))

    def holds(rank):
        return (F.col("before") <= rank) & (rank < F.col("before") + F.col("times"))

    spots = {name: (F.col("n") - 1) * F.lit(p) for name, p in probabilities.items()}
    wanted, picks = F.lit(False), []
    for name, at in spots.items():
        low, high = holds(F.floor(at)), holds(F.ceil(at))
        wanted = wanted | low | high
        picks += [F.max(F.when(low, v)).alias(f"_{name}_low"),
                  F.max(F.when(high, v)).alias(f"_{name}_high"),
                  F.max(at - F.floor(at)).alias(f"_{name}_part")]
    ends = [F.max(c).alias(c) for c in ("n", "min_value", "max_value")]
    picked = rows.filter(wanted).groupBy(group_col).agg(*picks, *ends)
    return picked.select(group_col, "n", "min_value", "max_value", *(
        (F.col(f"_{n}_low") + F.col(f"_{n}_part") * (F.col(f"_{n}_high") - F.col(f"_{n}_low")))
        .alias(n) for n in probabilities)), counted


def ranked(df: DataFrame, value_col: str, *, name: str = "rank", descending: bool = True,
           group_cols: Sequence[str] = ()) -> DataFrame:
    """``rank()`` by ``value_col`` over all rows (of a group): one more than the number of rows
    that come before in order; equal values share a rank, NULL comes last."""
    values = df.select(*group_cols, value_col).groupBy(*group_cols, value_col).agg(
        F.count(F.lit(1)).alias("_times"))
    # The key's sign turns the order round; NULL goes after everything.
    v = F.col(value_col)
    key = values.withColumn("_null", v.isNull()).withColumn("_key", -v if descending else v)
    placed = running_total(key, group_cols, ["_null", "_key"], weight="_times", name=name)
    keys = (*group_cols, value_col)
    placed = placed.select(*(F.col(c).alias(f"_of_{c}") for c in keys), (F.col(name) + 1).alias(name))
    return df.join(placed.hint("merge"), [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
                   ).select(*df.columns, name)


def chunked(df: DataFrame, series_cols: Sequence[str], time_col: str, *, rows_before: int,
            chunk: int, windows: Mapping[str, Callable[[Window], Column]],
            running: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Window columns over series of any length, a chunk of ``chunk`` rows at a time.

    ``windows`` maps a name to an expression of the window (partition and order) that looks
    back at most ``rows_before`` rows: each chunk also gets so many rows of the chunk before.
    ``running`` maps a name to ``(aggregate, column)``, ``max``, ``min`` or ``sum`` from the
    series' first row on: it is what the chunks before have, one row each, combined with
    the running value in the chunk. ``time_col`` must be unique in a series.
    """
    if chunk < max(rows_before, 1):
        raise ValueError("a chunk must be as long as the rows before it that it needs")
    placed = running_total(df, series_cols, [time_col], name="_pos")
    own = F.floor(F.col("_pos") / chunk).cast("long")
    late = F.col("_pos") % chunk >= chunk - rows_before
    both = F.array_compact(F.array(
        F.struct(own.alias("_chunk"), F.lit(False).alias("_halo")),
        F.when(late, F.struct((own + 1).alias("_chunk"), F.lit(True).alias("_halo")))))
    rows = placed.select("*", F.inline(both))
    w = Window.partitionBy(*series_cols, "_chunk").orderBy("_pos")
    out = rows.select("*", *(make(w).alias(name) for name, make in windows.items()))
    running = running or {}
    for name, (how, col) in running.items():  # rows of the chunk before do not count here
        mine = F.when(~F.col("_halo"), F.col(col))
        out = out.withColumn(f"_{name}", getattr(F, how)(mine).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = out.filter(~F.col("_halo"))
    if running:
        ends = placed.groupBy(*series_cols, own.alias("_chunk")).agg(
            *(getattr(F, how)(col).alias(f"_{name}_all") for name, (how, col) in running.items()))
        earlier = Window.partitionBy(*series_cols).orderBy("_chunk").rowsBetween(
            Window.unboundedPreceding, -1)
        carried = ends.select(*(F.col(c).alias(f"_of_{c}") for c in (*series_cols, "_chunk")), *(
            getattr(F, how)(f"_{name}_all").over(earlier).alias(f"_{name}_before")
            for name, (how, _) in running.items()))
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*series_cols, "_chunk")]
        merged = {"max": F.greatest, "min": F.least}
        # greatest and least skip NULL, as a running maximum does.
        values = [(merged[how](f"_{name}_before", f"_{name}") if how in merged else
                   F.when(F.coalesce(f"_{name}_before", f"_{name}").isNotNull(),
                          F.coalesce(f"_{name}_before", F.lit(0)) + F.coalesce(f"_{name}", F.lit(0)))
                   ).alias(name) for name, (how, _) in running.items()]
        return out.join(carried, same).select(*df.columns, *windows, *values)
    return out.select(*df.columns, *windows)


def in_order(df: DataFrame, order_cols: Sequence, files: int | None = None) -> DataFrame:
    """``df`` in partitions that follow each other in the order of ``order_cols``.

    Ranges are sampled, so partitions are of like size; rows that are equal in all order
    columns go to one, so a last, unique column keeps a hot value from filling it.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)


def write_ordered(df: DataFrame, path: str, order_cols: Sequence, *, files: int | None = None) -> None:
    """Write ``df`` as files that follow each other in the order of ``order_cols``."""
    in_order(df, order_cols, files).write.parquet(path)


def read_in_order(spark: SparkSession, path: str, name: str = "row_no") -> DataFrame:
    """A table of :func:`write_ordered` with each row's place in it, from 0: its place in
    its file and the rows of the files before, whose names sort by their ranges."""
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # One row a file.
    first = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("_file").alias("_of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_first"))
    return rows.join(first, F.col("_file") == F.col("_of")).select(
        *(c for c in rows.columns if c not in ("_file", "_row")),
        (F.col("_first") + F.col("_row")).cast("long").alias(name))
