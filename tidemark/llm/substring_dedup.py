"""Substring deduplication by prefix-partitioned suffix trees over words.

A window of ``WINDOW`` (13) words that also starts in a document with a smaller
doc_id is removed there, with every word it covers. Equal windows are the
internal nodes of depth ``WINDOW`` and more of the suffix tree of all texts, so:

1. Which suffixes can be that deep: of the 5-word hashes inside a window the
   least one stands for it, so equal windows have equal ones. A suffix goes on
   only if its least hash is met in two documents (about a fifth of the
   positions are shuffled, as 8-byte hashes).
2. The suffixes left are put in groups by prefix: ``PREFIX`` (10) words, and one
   word more at a time for prefixes with over ``CROWDED`` suffixes, and dealt to as
   many partitions as their number asks for, so that a group fits in a task's memory.
3. Each group is one subtree per prefix: its suffixes are sorted by their next
   words, lengths of common prefixes of neighbours give the internal nodes, and
   a node of depth ``WINDOW`` names the documents under it. All but the
   smallest lose the window.
4. Texts meet their windows again by doc_id and lose the covered words.

Within a task's slice of documents equal windows are first reduced to the one
with the smallest doc_id; the others are settled there. So a passage in a third
of all documents sends one suffix a slice.

Words are compared by 64-bit hashes (a prefix by a 64-bit hash of those, the
words after it by 32 bits each): unequal windows count as equal with
probability below 2^-64 a pair.

Defined cases: a null text has no words; a row without doc_id loses nothing and
takes nothing; rows with one doc_id are one document; repeated rows are
returned each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, release, save, shuffle_partitions
from tidemark.llm.flat import Flat, rolling, runs_inside, slices

WINDOW = 13
PREFIX = 10
GRAM = 5
CROWDED = 200_000
GROUP = 4_000_000  # hashes or suffixes that a task holds, about
_U = np.uint64
_M = _U(0xC2B2AE3D27D4EB4F)
_SLICE = 8_000_000  # bytes of text that a task looks at together


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), dtype)


def _fold(prefix: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Hash of a prefix and the words after it (columns of ``rest``)."""
    out = prefix.astype(_U, copy=True)
    for j in range(rest.shape[1]):
        out = (out ^ rest[:, j]) * _M
        out ^= out >> _U(32)
    return out


class _Words:
    """Word hashes of a slice, and the starts of all windows inside one text."""

    def __init__(self, texts: pa.Array):
        self.flat = Flat(texts)
        starts, ends, self.bounds = self.flat.words()
        self.hashes = self.flat.word_hashes(starts, ends)
        n = len(self.hashes)
        self.at = np.flatnonzero(runs_inside(self.bounds, n, WINDOW))
        self.owner = np.repeat(np.arange(self.flat.n), np.diff(self.bounds))[self.at]

    def least(self) -> np.ndarray:
        """For each window the least hash of its ``GRAM``-word runs."""
        h = rolling(self.hashes, GRAM)
        span, width = WINDOW - GRAM + 1, 1
        while 2 * width <= span:
            h = np.minimum(h[:len(h) - width], h[width:])
            width *= 2
        if width < span and len(h) > span - width:
            h = np.minimum(h[:len(h) - (span - width)], h[span - width:])
        return h[self.at] if len(self.at) else np.empty(0, _U)

    def suffixes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix hashes and next words of the suffixes that start at words ``at``."""
        prefix = rolling(self.hashes, PREFIX)[at] if len(at) else np.empty(0, _U)
        words = (self.hashes >> _U(32)).astype(np.uint32)
        rest = words[at[:, None] + np.arange(PREFIX, WINDOW)] if len(at) else np.empty(
            (0, WINDOW - PREFIX), np.uint32)
        return prefix, rest


def _smallest(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, first, least)``: rows sorted by key and doc; which of them begin
    a key; and each one's smallest doc."""
    order = np.lexsort((docs, keys))
    k = keys[order]
    first = np.r_[True, k[1:] != k[:-1]] if len(k) else np.empty(0, bool)
    least = docs[order][np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))]
    return order, first, least


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by bucket of their key."""
    b = ((keys >> _U(20)) % _U(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    cuts = np.searchsorted(b[order], np.arange(buckets + 1))
    for k in range(buckets):
        if cuts[k + 1] > cuts[k]:
            yield k, order[cuts[k]:cuts[k + 1]]


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def _groups(rows: DataFrame, windows) -> int:
    """How many partitions to deal ``windows`` (a sum over ``rows``) to, so that what one
    task holds does not grow with the data."""
    total = rows.agg(F.sum(windows)).first()[0] or 0
    return max(shuffle_partitions(rows.sparkSession), math.ceil(total / GROUP))


def repeated_hashes(docs: DataFrame) -> DataFrame:
    """``(doc_id, h)``: least hashes of a document's windows that another one has."""
    # About every fifth word sends a hash; a word has four bytes or more with its blank.
    n = _groups(_named(docs), F.octet_length("text") / 20)
    buckets = 4 * n
    names, kinds = ["kind", "bucket", "h", "doc"], [pa.int32(), pa.int32(), pa.binary(),
                                                    pa.binary()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for b in batches:
            ids = np.asarray(b.column(0))
            for k, texts in slices(b.column(1), _SLICE):
                w = _Words(texts)
                h, doc = w.least(), ids[k:k + w.flat.n][w.owner]
                new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][:len(h)]
                h, doc = h[new], doc[new]
                order, first, least = _smallest(h, doc)
                sorted_doc = doc[order]
                group = np.cumsum(first) - 1
                several = (np.bincount(group, sorted_doc != least) > 0)[group] if len(h) else first
                known = order[several]
                rows = [(0, k2, _pack(h[s]), _pack(doc[s]))
                        for s0 in [np.sort(order[first])]
                        for k2, t in _dealt(h[s0], buckets) for s in [s0[t]]]
                if len(known):
                    known.sort()
                    turn += 1
                    rows.append((1, (turn * 7919) % buckets, _pack(h[known]), _pack(doc[known])))
                yield _batch(rows, names, kinds)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, doc = [], []
        for b in batches:
            for kind, a, d in zip(b.column(0).to_pylist(), b.column(2).to_pylist(),
                                  b.column(3).to_pylist()):
                a, d = _unpack(a, _U), _unpack(d, np.int64)
                if kind:
                    yield pa.record_batch([pa.array(d), pa.array(a.view(np.int64))],
                                          names=["doc_id", "h"])
                else:
                    h.append(a)
                    doc.append(d)
        if h:
            h, doc = np.concatenate(h), np.concatenate(doc)
            order, first, least = _smallest(h, doc)
            group = np.cumsum(first) - 1
            several = (np.bincount(group, doc[order] != least) > 0)[group]
            at = order[several]
            for k in range(0, len(at), 500_000):
                s = at[k:k + 500_000]
                yield pa.record_batch([pa.array(doc[s]), pa.array(h[s].view(np.int64))],
                                      names=["doc_id", "h"])

    rows = _named(docs).where("doc_id IS NOT NULL").mapInArrow(
        emit, "kind int, bucket int, h binary, doc binary")
    return (rows.repartition(n, "bucket").mapInArrow(meet, "doc_id long, h long")
            .groupBy("doc_id").agg(F.collect_set("h").alias("hs")))


def candidate_suffixes(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Suffixes that may be deep nodes, packed by slice (``kind`` 0), and windows
    settled inside a slice (``kind`` 1)."""
    names = ["kind", "prefix", "rest", "doc"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = np.asarray(b.column(0)), b.column(2)
            for k, texts in slices(b.column(1), _SLICE):
                w = _Words(texts)
                part = lists.slice(k, w.flat.n)
                sizes = np.diff(part.offsets.to_numpy())
                mix = np.arange(w.flat.n, dtype=_U) * _M
                wanted = part.flatten().to_numpy().view(_U) ^ np.repeat(mix, sizes)
                on = np.isin(w.least() ^ mix[w.owner], wanted)
                at, doc = w.at[on], ids[k:k + w.flat.n][w.owner[on]]
                prefix, rest = w.suffixes(at)
                order, first, least = _smallest(_fold(prefix, rest), doc)
                settled = order[doc[order] > least]
                send = np.sort(order[first])  # in text order the documents compress well
                rows = [(0, _pack(prefix[send]), _pack(rest[send]), _pack(doc[send])),
                        (1, _pack(_fold(prefix[settled], rest[settled])), b"",
                         _pack(doc[settled]))]
                yield _batch(rows, names, kinds)

    return _named(docs).join(repeated, "doc_id").select("doc_id", "text", "hs").mapInArrow(
        emit, "kind int, prefix binary, rest binary, doc binary")


def _crowded(packed: DataFrame, crowded: int, extra: int, longer: list[np.ndarray]) -> np.ndarray:
    """Prefixes of ``PREFIX + extra`` words with over ``crowded`` suffixes: at
    most one for each ``crowded`` suffixes reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys = _keys(_unpack(p, _U), _unpack(r, np.uint32), longer, extra)
                got, n = np.unique(keys, return_counts=True)
                often = n > 1  # a prefix met once a slice has at most as many as slices
                yield pa.record_batch([pa.array(got[often].view(np.int64)), pa.array(n[often])],
                                      names=["p", "n"])

    got = (packed.where("kind = 0").select("prefix", "rest").mapInArrow(count, "p long, n long")
           .groupBy("p").agg(F.sum("n").alias("n")).where(F.col("n") > crowded)
           .select("p").collect())
    return np.sort(np.array([r[0] for r in got], np.int64).view(_U))


def _keys(prefix: np.ndarray, rest: np.ndarray, longer: list[np.ndarray],
          extra: int | None = None) -> np.ndarray:
    """Group keys: the prefix's hash, taken one word on while it is in the list of
    crowded prefixes of its length."""
    rest = rest.reshape(-1, WINDOW - PREFIX)
    key, on = prefix.copy(), np.ones(len(prefix), bool)
    for j, heavy in enumerate(longer[:extra] if extra is not None else longer):
        on &= np.isin(key, heavy)
        if not on.any():
            break
        key[on] = _fold(key[on], rest[on, j:j + 1])
    if extra is not None:
        return key[on]
    return key


def deep_nodes(prefix: np.ndarray, rest: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Suffixes under a node of ``WINDOW`` words that are not its smallest document's.

    Sorted suffixes with the lengths of their common prefixes are the subtree;
    a node of depth ``d`` is a maximal run of neighbours that share ``d`` words.
    """
    order = np.lexsort((doc, *rest.T[::-1], prefix))
    p, r, d = prefix[order], rest[order], doc[order]
    shared = np.where(p[1:] == p[:-1], PREFIX, 0)
    going = shared > 0
    for j in range(r.shape[1]):
        going &= r[1:, j] == r[:-1, j]
        shared += going
    begins = np.r_[True, shared < WINDOW]
    least = d[np.maximum.accumulate(np.where(begins, np.arange(len(d)), 0))]
    return order[d > least]


def removed_windows(packed: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(doc_id, w)``: hashes of the windows that a document loses."""
    n = _groups(packed.where("kind = 0"), F.octet_length("prefix") / 8)
    buckets = 4 * n
    longer: list[np.ndarray] = []
    for extra in range(WINDOW - PREFIX):
        heavy = _crowded(packed, crowded, extra, longer)
        if not len(heavy):
            break
        longer.append(heavy)
    names = ["bucket", "prefix", "rest", "doc"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def rows(d, w):
        for k in range(0, len(d), 500_000):
            yield pa.record_batch([pa.array(d[k:k + 500_000]),
                                   pa.array(w[k:k + 500_000].view(np.int64))],
                                  names=["doc_id", "w"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, r, d in zip(*(c.to_pylist() for c in b.columns)):
                p, d = _unpack(p, _U), _unpack(d, np.int64)
                r = _unpack(r, np.uint32).reshape(-1, WINDOW - PREFIX)
                yield _batch([(k, _pack(p[s]), _pack(r[s]), _pack(d[s]))
                              for k, s in _dealt(_keys(p, r, longer), buckets)], names, kinds)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, rest, doc = [], [], []
        for b in batches:
            for p, r, d in zip(*(b.column(c).to_pylist() for c in (1, 2, 3))):
                prefix.append(_unpack(p, _U))
                rest.append(_unpack(r, np.uint32).reshape(-1, WINDOW - PREFIX))
                doc.append(_unpack(d, np.int64))
        if prefix:
            prefix, rest, doc = map(np.concatenate, (prefix, rest, doc))
            at = deep_nodes(prefix, rest, doc)
            yield from rows(doc[at], _fold(prefix[at], rest[at]))

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w, d in zip(*(c.to_pylist() for c in b.columns)):
                yield from rows(_unpack(d, np.int64), _unpack(w, _U))

    out = "doc_id long, w long"
    dealt = packed.where("kind = 0").select("prefix", "rest", "doc").mapInArrow(
        deal, "bucket int, prefix binary, rest binary, doc binary")
    return dealt.repartition(n, "bucket").mapInArrow(group, out).unionByName(
        packed.where("kind = 1").select("prefix", "doc").mapInArrow(settled, out))


def _cut(docs: DataFrame, lost: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            for k, texts in slices(b.column(1), _SLICE):
                w = _Words(texts)
                part = lists.slice(k, w.flat.n)
                sizes = np.diff(part.offsets.to_numpy())
                mix = np.arange(w.flat.n, dtype=_U) * _M
                wanted = part.flatten().to_numpy().view(_U) ^ np.repeat(mix, sizes)
                gone = np.zeros(len(w.hashes) + 1, np.int64)
                if len(wanted):
                    has = np.flatnonzero(np.isin(w.owner, np.flatnonzero(sizes)))
                    found = _fold(*w.suffixes(w.at[has])) ^ mix[w.owner[has]]
                    at = w.at[has[np.isin(found, wanted)]]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + WINDOW, -1)
                keep = np.cumsum(gone[:-1]) == 0
                total = np.r_[0, np.cumsum(keep)]
                n_words = np.diff(w.bounds)
                n_kept = total[w.bounds[1:]] - total[w.bounds[:-1]]
                kept = []
                for i, t in enumerate(texts.cast(pa.binary()).to_pylist()):
                    words = t.split()
                    if n_kept[i] < n_words[i]:
                        flags = keep[w.bounds[i]:w.bounds[i + 1]]
                        words = [words[j] for j in np.flatnonzero(flags).tolist()]
                    kept.append(b" ".join(words))
                yield pa.record_batch(
                    [b.column(0).slice(k, w.flat.n), pa.array(n_words), pa.array(n_words - n_kept),
                     pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])

    none = F.array().cast("array<bigint>")
    rows = _named(docs).join(lost, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("ws", none).alias("ws"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def dedup(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every row; ``kept`` is the text
    that stays, its words joined by one space."""
    spark = docs.sparkSession
    repeated = save(repeated_hashes(docs), "repeated")
    release(spark)
    packed = save(candidate_suffixes(docs, repeated), "suffixes")
    discard(repeated)
    release(spark)
    lost = save(removed_windows(packed, crowded), "lost")
    discard(packed)
    release(spark)
    return _cut(docs, lost.groupBy("doc_id").agg(F.collect_set("w").alias("ws")))
