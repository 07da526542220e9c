"""Packing of token pieces into sequences by patterns and non-negative least squares.

A document's ids (``end_id`` appended) are one piece, or, beyond ``capacity``
ids, pieces of ``capacity`` with the remainder first. Only the histogram of
piece lengths, at most ``capacity`` numbers, reaches the driver. There

1. patterns are listed: all multisets of up to three present lengths that fill
   a sequence exactly (a length in none of them gets one that nothing more fits into),
2. repeat counts ``x >= 0`` minimise ``|W (A x - histogram)|^2`` by an active set, which
   ends at fewer patterns than lengths; long lengths weigh more: a long piece left over
   costs a sequence, a short one fills a gap,
3. counts are rounded, never above what is left of a length, and what rounding leaves is
   fitted in the same way while that places pieces in number,
4. residual lengths are packed best fit, longest first, on counts.

The plan (patterns with counts) is turned into slots by length and rank, and
every piece finds its slot by its rank among pieces of its length. Ranks come
from a count in each task plus a running sum over tasks, so a length that a
third of all pieces share is never gathered anywhere.

Defined cases: a null text is empty (one piece of the end id alone); repeated
rows are packed each; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import save
from tidemark.llm.tokens import encoded

PIECES = ("doc_id long, piece int, start long, length long, ids binary, "
          "task int, nth long")


def pieces(docs: DataFrame, tokenizer: str, *, end_id: int = 2,
           capacity: int = 1024) -> DataFrame:
    """Pieces of all ``docs`` with their ids (little-endian unsigned 32-bit).

    ``nth`` counts a task's pieces of one length, from 0.
    """
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        end = end_id.to_bytes(4, "little")
        rows, size = [], 0

        def batch():
            return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                                   names=names)

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), encoded(b.column(1), tokenizer)):
                ids = ids.astype("<u4").tobytes() + end
                n = len(ids) // 4
                start, length = 0, (n - 1) % capacity + 1
                for k in range(-(-n // capacity)):
                    rows.append((doc_id, k, start, length, ids[4 * start:4 * (start + length)],
                                 task, seen[length]))
                    seen[length] += 1
                    start, length = start + length, capacity
                size += len(ids)
                if size > 8_000_000:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)
    return save(out, "pieces")


def patterns(present: np.ndarray, capacity: int) -> np.ndarray:
    """Rows ``(a, b, c)``, a >= b >= c >= 0, of present lengths: all with sum
    ``capacity``, and a full one for lengths that are in none of those."""
    has = np.zeros(capacity + 1, bool)
    has[present] = True
    out = [np.array([[capacity, 0, 0]])] if has[capacity] else []
    b = np.arange(1, capacity // 2 + 1)
    two = b[has[b] & has[capacity - b]]
    out.append(np.stack([capacity - two, two, np.zeros_like(two)], 1))
    for c in present[present <= capacity // 3]:
        b = np.arange(c, (capacity - c) // 2 + 1)
        b = b[has[b] & has[capacity - c - b]]
        out.append(np.stack([capacity - c - b, b, np.full_like(b, c)], 1))
    pats = np.concatenate(out)
    # A length in no exact pattern gets the ones that nothing more fits into.
    more = []
    for a in np.setdiff1d(present, pats):
        b = present[present <= capacity - a].max(initial=0)
        c = present[present <= capacity - a - b].max(initial=0)
        if capacity - a - b - c < present[0]:
            more.append(np.sort([a, b, c])[::-1])
    return np.concatenate([pats, np.unique(more, axis=0)]) if more else pats


def nnls(pats: np.ndarray, hist: np.ndarray, rounds: int = 6, close: float = 1e-3) -> np.ndarray:
    """Repeat counts >= 0 that fit ``hist`` in weighted least squares, few of them above zero.

    Active set: of the patterns that the residual asks for, the ones asked for most with each
    longest and with each shortest length join the set; the set is solved by normal
    equations; what becomes negative leaves it. So counts gather on fewer patterns than
    there are lengths, and rounding them loses little. Ends after ``rounds`` or when the
    residual is ``close`` to nothing.
    """
    n = len(hist)
    weight = np.r_[0.0, 0.3 + 0.7 * np.arange(1, n) / (n - 1)]  # zeros fill short patterns
    goal = hist * weight
    chosen, x, left = np.empty(0, np.int64), np.empty(0), goal
    for _ in range(rounds):
        asked = (left * weight)[pats].sum(1)
        most = []
        for end in (pats[:, 0], pats[:, 2]):
            order = np.lexsort((asked, end))
            most.append(order[np.r_[end[order[1:]] != end[order[:-1]], True]])
        new = np.unique(np.concatenate(most))
        new = np.setdiff1d(new[asked[new] > 1e-9 * (goal @ goal)], chosen)
        if not len(new):
            break
        chosen = np.concatenate([chosen, new])
        while len(chosen):
            own = np.zeros((n, len(chosen)))
            np.add.at(own, (pats[chosen].ravel(), np.repeat(np.arange(len(chosen)), 3)), 1.0)
            own *= weight[:, None]
            square = own.T @ own
            square[np.diag_indices_from(square)] += 1e-9
            x = np.linalg.solve(square, own.T @ goal)
            if (x > 0).all():
                break
            chosen = chosen[x > 0]
        left = goal - (own @ x if len(chosen) else 0)
        if not len(chosen) or left @ left <= close ** 2 * (goal @ goal):
            break
    out = np.zeros(len(pats))
    out[chosen] = x[:len(chosen)]
    return out


def best_fit(hist: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts of lengths: ``(pattern, count)``."""
    open_: dict[int, list[list]] = {}  # space left -> [pattern, count]
    for length in range(capacity, 0, -1):
        left = int(hist[length])
        for space in range(length, capacity):
            if not left:
                break
            # What is put in here moves to a smaller space, which may still fit.
            while left and open_.get(space):
                pattern, n = open_[space].pop()
                fit = min(space // length, left) or 1
                m = min(n, left // fit)
                if n > m:
                    open_[space].append([pattern, n - m])
                open_.setdefault(space - fit * length, []).append(
                    [pattern + (length,) * fit, m])
                left -= m * fit
        while left:
            fit = min(capacity // length, left)
            m = left // fit
            open_.setdefault(capacity - fit * length, []).append([(length,) * fit, m])
            left -= m * fit
    return [(tuple(p), n) for group in open_.values() for p, n in group]


def fitted(hist: np.ndarray, capacity: int, least: float = 0.01) -> tuple[list, np.ndarray]:
    """Patterns with counts, and what they leave of ``hist``. The residual of rounding is
    fitted again as long as that places the share ``least`` of all pieces."""
    left, out, total = hist.copy(), [], int(hist.sum())
    while left.any():
        before = int(left.sum())
        pats = patterns(np.flatnonzero(left), capacity)
        if not len(pats):
            break
        x = nnls(pats, left.astype(float))
        # Longest lengths first: they fit least patterns.
        for k in np.lexsort((-pats[:, 1], -pats[:, 0])):
            n = int(x[k] + 0.5)
            if n == 0:
                continue
            lens, need = np.unique(pats[k][pats[k] > 0], return_counts=True)
            n = min(n, int((left[lens] // need).min()))
            if n > 0:
                left[lens] -= n * need
                out.append((tuple(int(v) for v in pats[k] if v), n))
        if before - int(left.sum()) < least * total:
            break
    return out, left


def plan(hist: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths of a sequence, how many such sequences)`` for the histogram."""
    left = np.asarray(hist, np.int64).copy()
    left[0] = 0
    out, left = fitted(left, capacity)
    return out + best_fit(left, capacity)


def slots(sequences: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Runs ``(length, first rank, first sequence, offset)`` sorted by length and rank."""
    used: dict[int, int] = {}
    runs, first = [], 0
    for pattern, n in sequences:
        offset = 0
        for length in pattern:
            runs.append((length, used.get(length, 0), first, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        first += n
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack(piece_table: DataFrame, capacity: int = 1024) -> DataFrame:
    """``piece_table`` (of :func:`pieces`; its columns but ``task``, ``nth`` and
    ``length`` may be left out or added to) with ``sequence_id`` and ``offset``."""
    spark = piece_table.sparkSession
    counts = save(piece_table.groupBy("task", "length").count(), "piece-counts")
    hist = np.zeros(capacity + 1, np.int64)
    # At most `capacity` rows, whatever the input.
    for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():
        hist[r["length"]] = r["n"]
    length, rank, seq, offset = slots(plan(hist, capacity))
    # Bounded by the number of patterns, not by documents.
    runs = spark.sparkContext.broadcast(
        ((length << 44) + rank, rank, seq, offset))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(
        F.sum("count").over(before), F.lit(0)).cast("long").alias("base"))
    # The bases grow with the number of tasks: a shuffle join at every size.
    out = piece_table.join(base.hint("merge"), ["task", "length"]).withColumn(
        "rank", F.col("base") + F.col("nth")).drop("base", "task", "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, firsts, seqs, offsets = runs.value
        for b in batches:
            n, r = np.asarray(b.column("length")), np.asarray(b.column("rank"))
            k = np.searchsorted(keys, (n << 44) + r, "right") - 1
            b = b.drop_columns(["rank"])
            yield pa.record_batch([*b.columns, pa.array(seqs[k] + r - firsts[k]),
                                   pa.array(offsets[k])],
                                  names=[*b.schema.names, "sequence_id", "offset"])

    placed = StructType([*out.drop("rank").schema.fields,
                         StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return out.mapInArrow(run, placed)


def sequences(placed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the ids of each sequence in place, from pieces that
    were packed with their ``ids``; a group is at most a sequence long."""
    parts = placed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("p"))
    return parts.select("sequence_id", F.unhex(F.array_join("p.ids", "")).alias("ids"))
