"""Ranked lexical search by norm buckets.

A document is a vector of impacts, an item a vector of term weights, a score their
product; all of it 64-bit integers. The items are a stated query set, compared with all
rows in blocks whose terms fit a fixed bound.

1. One pass over the texts gives every document its length and the counts of the
   block's terms. N, L and document frequencies follow by aggregation.
2. A task takes its vectors in slabs of bounded size, orders a slab by vector length and
   cuts it into buckets. An item leaves out a bucket if |item| * (greatest length) is
   below its threshold (Cauchy-Schwarz).
3. Inside a bucket, coordinate bounds: the item's focus coordinates, its heaviest terms,
   are multiplied out over the bucket's postings; what the other coordinates can add is
   at most the product of what is left of both lengths. Documents below the threshold go.
4. Survivors are scored exactly, in integers.

Thresholds come from a first round over each slab's longest bucket: the ``k``-th best
score there is a lower bound for the whole table. In the second round they rise within
a task. A task returns at most ``k`` rows an item, which one ranking per item merges.
Bounds use doubles with a margin over their rounding error, so no true hit is lost;
ties with the threshold stay.

Defined cases: null or termless texts match nothing; items without a term get no row;
rows of one ``item_id`` are one item, a null ``item_id`` too; repeated documents are
ranked each; ties go to the least ``doc_id``, null last; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, save
from tidemark.llm.flat import Flat, slices

#: A term is a maximal run of characters outside these ranges, A-Z lower-cased.
TERM_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes outside terms become blanks, capitals small letters.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:128] = [ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)]

VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
_NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id, so that it is last


def terms(text: Column) -> Column:
    """All terms of ``text`` in order, with repeats."""
    return F.regexp_extract_all(F.translate(text.cast("string"), _UPPER, _LOWER),
                                F.lit(f"({TERM_RE})"), F.lit(1))


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms, and where each text's begin."""
    flat = Flat(texts)
    flat.data = _BYTES[flat.data]
    starts, ends, bounds = flat.words()
    return flat.word_hashes(starts, ends), bounds


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``(doc_id, n, terms, counts)`` of every document with a term: ``n`` counts all its
    terms, ``terms`` are places in the sorted hashes ``vocabulary``."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by `search`

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for b in batches:
            for first, texts in slices(b.column(1)):
                h, bounds = _hashes(texts)
                at = np.searchsorted(known, h)
                at[at == len(known)] = 0
                found = np.flatnonzero(known[at] == h)
                doc = np.searchsorted(bounds, found, "right") - 1
                key, count = np.unique(doc * len(known) + at[found], return_counts=True)
                doc, term = np.divmod(key, len(known))
                n = np.diff(bounds)
                keep = np.flatnonzero(n)
                # Documents without any term hold none of the vocabulary either.
                ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(n)))[keep]]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)).take(pa.array(keep)),
                     pa.array(n[keep], pa.int64()), _lists(term, ends), _lists(count, ends)],
                    ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return save(rows.mapInArrow(run, VECTORS), "vectors")


class Queries:
    """Items of a block as sparse integer vectors over the vocabulary."""

    def __init__(self, item_ids: list, item_terms: list[np.ndarray], weights: np.ndarray,
                 focus: int):
        self.item_ids, self.size = item_ids, len(weights)
        self.terms, self.weights, self.focus, rest = [], [], [], []
        for t in item_terms:
            t = t[weights[t] > 0]  # a weight of 0 adds nothing
            w = weights[t]
            order = np.argsort(-w, kind="stable")[:focus]
            self.terms.append(t)
            self.weights.append(w)
            self.focus.append(t[order])
            rest.append(np.sqrt(max(float((w.astype(float) ** 2).sum()
                                          - (w[order].astype(float) ** 2).sum()), 0.0)))
        self.norm = np.array([np.sqrt((w.astype(float) ** 2).sum()) for w in self.weights])
        self.rest = np.array(rest)
        self.all_weights = weights


class Best:
    """The ``k`` best documents of each item so far: score descending, doc_id ascending."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()  # nothing below `floor` can be among the best
        self.scores = [np.empty(0, np.int64)] * n
        self.docs = [np.empty(0, np.int64)] * n

    def add(self, q: int, scores: np.ndarray, docs: np.ndarray) -> None:
        keep = scores >= max(self.floor[q], 1)
        if not keep.any():
            return
        s, d = np.r_[self.scores[q], scores[keep]], np.r_[self.docs[q], docs[keep]]
        order = np.lexsort((d, -s))[:self.k]
        self.scores[q], self.docs[q] = s[order], d[order]
        if len(order) == self.k:
            self.floor[q] = max(self.floor[q], self.scores[q][-1])


def impacts(counts: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """Impact of a term with ``counts`` occurrences in a document of ``n`` terms."""
    m = 100 - 90 + (90 * n * total_docs) // total_terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start .. start + size - 1`` of all runs, end to end."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def search_bucket(queries: Queries, best: Best, doc_ids: np.ndarray, ends: np.ndarray,
                  term: np.ndarray, impact: np.ndarray, length: np.ndarray) -> int:
    """Compare a bucket (documents by falling ``length``; document ``k`` has the postings
    ``ends[k]:ends[k + 1]``) with all items; returns how many pairs were scored exactly."""
    floor = np.maximum(best.floor, 1).astype(float)
    alive = np.flatnonzero(queries.norm * length[0] * (1 + 1e-9) >= floor)
    if not len(alive) or not len(term):
        return 0
    owner = np.repeat(np.arange(len(doc_ids)), np.diff(ends))
    order = np.argsort(term, kind="stable")
    by_term, by_owner, by_impact = term[order], owner[order], impact[order].astype(float)
    lookup = np.zeros(queries.size, np.int64)
    scored = 0
    for q in alive:
        t = queries.focus[q]
        a, b = np.searchsorted(by_term, t, "left"), np.searchsorted(by_term, t, "right")
        at = _ranges(a, b - a)
        w = np.repeat(queries.all_weights[t], b - a)
        part = np.bincount(by_owner[at], w * by_impact[at], len(doc_ids))
        used = np.bincount(by_owner[at], by_impact[at] ** 2, len(doc_ids))
        more = queries.rest[q] * np.sqrt(np.maximum(length ** 2 - used, 0) + length ** 2 * 1e-9)
        left = np.flatnonzero((part + more) * (1 + 1e-9) >= max(best.floor[q], 1))
        if not len(left):
            continue
        scored += len(left)
        size = ends[left + 1] - ends[left]
        at = _ranges(ends[left], size)
        lookup[queries.terms[q]] = queries.weights[q]
        exact = np.zeros(len(left), np.int64)
        np.add.at(exact, np.repeat(np.arange(len(left)), size), lookup[term[at]] * impact[at])
        lookup[queries.terms[q]] = 0
        best.add(q, exact, doc_ids[left])
    return scored


def _slabs(batches: Iterator[pa.RecordBatch], rows: int, postings: int) -> Iterator[list]:
    held, n, p = [], 0, 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        p += len(b.column(2).flatten())
        if n >= rows or p >= postings:
            yield held
            held, n, p = [], 0, 0
    if held:
        yield held


def _round(table: DataFrame, queries: Queries, floor: np.ndarray, totals: tuple[int, int], k: int,
           bucket: int, longest_only: bool) -> DataFrame:
    """``(item, doc_id, score)``: each task's best ``k`` documents of every item."""
    held = table.sparkSession.sparkContext.broadcast((queries, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = held.value
        best = Best(len(own.item_ids), k, least)
        for slab in _slabs(batches, 32 * bucket, 2_000_000):
            ids = np.concatenate([b.column(0).fill_null(_NO_ID).to_numpy() for b in slab])
            n = np.concatenate([b.column(1).to_numpy() for b in slab])
            size = np.concatenate([b.column(2).value_lengths().to_numpy() for b in slab])
            term = np.concatenate([b.column(2).flatten().to_numpy() for b in slab])
            count = np.concatenate([b.column(3).flatten().to_numpy() for b in slab])
            impact = impacts(count.astype(np.int64), np.repeat(n, size), *totals)
            starts = np.cumsum(size) - size
            length = np.sqrt(np.bincount(np.repeat(np.arange(len(size)), size),
                                         impact.astype(float) ** 2, len(size)))
            order = np.argsort(-length, kind="stable")
            for first in range(0, len(order), bucket):
                part = order[first:first + bucket]
                at = _ranges(starts[part], size[part])
                search_bucket(own, best, ids[part], np.r_[0, np.cumsum(size[part])],
                              term[at], impact[at], length[part])
                if longest_only:
                    break
        rows = [(q, int(d), int(s)) for q in range(len(own.item_ids))
                for d, s in zip(best.docs[q], best.scores[q])]
        item, doc, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array([None if d == _NO_ID else d for d in doc],
                                                  pa.int64()), pa.array(score, pa.int64())],
            ["item", "doc_id", "score"])

    return table.mapInArrow(run, "item int, doc_id long, score long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item with their rank. Tasks bring at most ``k`` rows an
    item, and Spark keeps the best ``k`` of each task's again before the shuffle."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, focus: int = 8, bucket: int = 1024,
           block_items: int = 5000, block_terms: int = 400_000) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best ``docs`` (``doc_id``, ``text``) of
    every item (``item_id``, ``text``) with a score above 0.

    ``block_items`` and ``block_terms`` bound what is held and broadcast at once; each
    block of items costs a pass over the documents.
    """
    words = F.array_distinct(F.flatten(F.collect_set(terms(F.coalesce("text", F.lit(""))))))
    own = save(items.groupBy(F.col("item_id").cast("long").alias("item_id"))
               .agg(words.alias("terms")).where(F.size("terms") > 0), "items")
    out, block, n = None, [], 0
    for r in own.toLocalIterator():  # a block at a time
        block.append((r["item_id"], list(r["terms"])))
        n += len(r["terms"])
        if len(block) >= block_items or n >= block_terms:
            found = _search_block(docs, block, k, focus, bucket)
            out, block, n = found if out is None else out.unionByName(found), [], 0
    if block or out is None:
        found = _search_block(docs, block, k, focus, bucket)
        out = found if out is None else out.unionByName(found)
    return out


def _search_block(docs: DataFrame, block: list, k: int, focus: int, bucket: int) -> DataFrame:
    spark = docs.sparkSession
    if not block:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    hashed = [_hashes(pa.array([" ".join(t)]))[0] for _, t in block]
    vocabulary = np.unique(np.concatenate(hashed))
    table = vectors(docs, vocabulary)
    totals = table.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    total_docs, total_terms = totals["docs"], totals["terms"] or 1
    weights = np.zeros(len(vocabulary), np.int64)
    frequency = table.select(F.explode("terms").alias("term")).groupBy("term").count()
    weight = F.floor(1000 * F.log((2.0 * total_docs + 2) / (2.0 * F.col("count") + 1)))
    for r in frequency.select("term", weight.alias("w")).collect():  # at most the vocabulary
        weights[r["term"]] = r["w"]
    queries = Queries([i for i, _ in block], [np.searchsorted(vocabulary, h) for h in hashed],
                      weights, focus)
    floor = np.zeros(len(block), np.int64)
    first = _ranked(_round(table, queries, floor, (total_docs, total_terms), k, bucket, True), k)
    for r in first.where(F.col("rank") == k).collect():  # one row an item of the block
        floor[r["item"]] = r["score"]
    hits = save(_ranked(_round(table, queries, floor, (total_docs, total_terms), k, bucket, False),
                        k), "hits")
    discard(table)
    names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(block)],
                                  "item int, item_id long")
    return hits.join(names, "item").select("item_id", "rank", "doc_id", "score")
