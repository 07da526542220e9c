"""Near-duplicate documents by SimHash and a binary trie self-join.

Fingerprint: words are split at ASCII white space after lower-casing A-Z,
shingles are ``shingle`` consecutive words joined by a space (a shorter text is
one shingle), each shingle's XXH64 with seed 42 votes on 64 bits, and a bit is
set where more than half of the votes are ones.

Join: two fingerprints within ``max_bits`` (3) differing bits agree on one of
``max_bits + 1`` (4) 16-bit blocks, so each rotation that brings a block to the
front has a binary trie, and node pairs need following only from the diagonal
pairs at depth 16. A pair of trie nodes is walked downwards together; the
differing bits add up, and a pair beyond the budget is dropped with all below
it. Nodes of at most ``NODE`` fingerprints are walked inside one task. Larger
ones are first split in DataFrame steps of eight bits with the same pruning, so
no task holds more than two nodes, however many documents share a block.
A task returns a spanning star per local component, not all its pairs.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; equal texts have equal fingerprints; repeated rows are all returned; a
null ``doc_id`` never becomes a component id unless the component has no other;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, save, shuffle_partitions
from tidemark.llm.flat import give_back

#: Largest number of fingerprints of a trie node that one task walks.
NODE = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: For each byte its eight bits, most significant first, one in each byte of a word.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
_U = np.uint64


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of a text as a signed 64-bit integer."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_digest
    votes = np.frombuffer(b"".join([digest(s, 42) for s in parts]), np.uint8).reshape(-1, 8)
    n = len(votes)
    # Byte lanes hold up to 255 votes before they are widened.
    lanes = np.add.reduceat(_SPREAD[votes], np.arange(0, n, 255), axis=0)
    ones = lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row of ``docs`` (columns ``doc_id``, ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            give_back()
            texts = b.column(1).cast(pa.binary())
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            yield pa.record_batch([b.column(0), fps], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def walk(keys: np.ndarray, pairs: list[tuple[int, int, int, int]], first_bit: int,
         budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``keys`` within ``budget`` bits, by walking trie node pairs.

    A node is a range of ``keys`` (uint64, sorted inside every range given); its
    children at a bit are the zeros and the ones of that range. ``pairs`` holds
    ``(a_lo, a_hi, b_lo, b_hi)``, equal ranges for a node with itself.
    """
    p = np.array(pairs, np.int64).reshape(-1, 4)
    alo, ahi, blo, bhi = p.T
    d = np.zeros(len(p), np.int8)
    found_i, found_j = [], []
    for bit in range(first_bit, 65):
        same = alo == blo
        keep = (ahi > alo) & (bhi > blo) & (d <= budget) & ~(same & (ahi - alo == 1))
        single = keep & (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            ok = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            found_i.append(i[ok])
            found_j.append(j[ok])
        keep &= ~single
        if not keep.any():
            break
        alo, ahi, blo, bhi, d, same = (x[keep] for x in (alo, ahi, blo, bhi, d, same))
        if bit == 64:
            raise ValueError("keys of a node must be distinct")
        ones = np.concatenate([[0], np.cumsum((keys >> _U(63 - bit)) & _U(1), dtype=np.int64)])
        am = ahi - (ones[ahi] - ones[alo])
        bm = bhi - (ones[bhi] - ones[blo])
        x = ~same
        alo, ahi, blo, bhi, d = (
            np.concatenate([alo, am, alo, am[x]]), np.concatenate([am, ahi, am, ahi[x]]),
            np.concatenate([blo, bm, bm, blo[x]]), np.concatenate([bm, bhi, bhi, bm[x]]),
            np.concatenate([d, d, d + 1, d[x] + 1]))
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` items the least item that the pairs connect it to."""
    lab = np.arange(n)
    while len(i):
        m = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        np.minimum.at(new, lab[i], m)
        np.minimum.at(new, lab[j], m)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    return lab


def _walk_tasks(first_bit: int, budget: int):
    """Arrow batches of ``(task, side, key)`` sorted by those: links per task, as
    fingerprints. ``side`` is twice the rotation, plus one for a second node."""
    def links(task: np.ndarray, side: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, (task[1:] != task[:-1]) | (side[1:] != side[:-1])])
        ends = np.r_[starts[1:], len(task)]
        a, b = [], []
        pairs, work = [], 0

        def flush():
            nonlocal pairs, work
            if pairs:
                i, j = walk(key, pairs, first_bit, budget)
                lab = stars(len(key), i, j) if len(i) else np.arange(len(key))
                moved = np.flatnonzero(lab != np.arange(len(key)))
                back = (side[moved] // 2 * first_bit).astype(_U)
                for to, k in ((a, key[moved]), (b, key[lab[moved]])):
                    to.append(np.where(back, (k >> back) | (k << (_U(64) - back) % _U(64)), k))
            pairs, work = [], 0

        k = 0
        while k < len(starts):
            s, e = starts[k], ends[k]
            if side[s] % 2 == 0 and k + 1 < len(starts) and task[starts[k + 1]] == task[s]:
                pairs.append((s, e, starts[k + 1], ends[k + 1]))
                work += (e - s) * (ends[k + 1] - starts[k + 1])
                k += 2
            else:
                if e - s > 1:
                    pairs.append((s, e, s, e))
                    work += (e - s) ** 2
                k += 1
            if work > 2 * NODE * NODE:
                flush()
        flush()
        out = [np.concatenate(x) if x else np.empty(0, _U) for x in (a, b)]
        return pa.record_batch([pa.array(x.view(np.int64)) for x in out], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last task seen, which may go on in the next batch
        for batch in batches:
            cols = [np.asarray(c) for c in batch.columns]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            cut = np.searchsorted(cols[0], cols[0][-1])
            held = [c[cut:] for c in cols]
            if cut:
                yield links(cols[0][:cut], cols[1][:cut], cols[2][:cut].view(np.uint64))
        if held is not None:
            yield links(held[0], held[1], held[2].view(np.uint64))

    return run


def _prefix(key, depth: int):
    return F.shiftrightunsigned(key, 64 - depth) if depth < 64 else key


def trie_links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct fingerprints ``fps`` (column
    ``fp``) exactly as all pairs within ``max_bits`` bits do."""
    spark = fps.sparkSession
    width = 64 // (max_bits + 1)
    # One trie per rotation; (root, key) with the rotation's number in the root.
    turned = [F.struct(F.lit(r).alias("r"),
                       (F.col("fp") if r == 0 else
                        F.shiftleft("fp", r * width).bitwiseOR(
                            F.shiftrightunsigned("fp", 64 - r * width))).alias("key"))
              for r in range(max_bits + 1)]
    turns = fps.select(F.explode(F.array(*turned)).alias("t")).select("t.r", "t.key")
    members = turns.withColumn("root", F.col("r") * F.lit(1 << width)
                               + _prefix(F.col("key"), width)).select("root", "r", "key")
    heavy = save(members.groupBy("root").count().where(F.col("count") > NODE), "roots")
    tasks = members.select(F.col("root").alias("task"), (2 * F.col("r")).alias("side"), "key")
    if not heavy.isEmpty():
        tasks = tasks.join(heavy.select(F.col("root").alias("task")), "task", "left_anti")
        most = heavy.agg(F.max("count")).first()[0]
        split = _split(save(members.join(heavy.select("root"), "root"), "crowded"), width,
                       max_bits, most)
        tasks = tasks.unionByName(split)
    tasks = (tasks.repartition(shuffle_partitions(spark), "task")
             .sortWithinPartitions("task", "side", "key"))
    links = tasks.mapInArrow(_walk_tasks(width, max_bits), "a long, b long")
    return links


def _bits(most: int) -> int:
    """By how many bits to split so that nodes of ``most`` keys come near ``NODE``: each bit
    more copies keys into more pairs of nodes."""
    return min(max(math.ceil(math.log2(most / NODE)), 1), 8)


def _split(members: DataFrame, width: int, budget: int, most: int) -> DataFrame:
    """Tasks of node pairs below crowded roots, every node at most ``NODE`` keys; ``most``
    is the number of keys of the largest root."""
    depth = width
    top = members.groupBy("root").agg(F.min(_prefix(F.col("key"), width)).alias("pa"))
    frontier = top.select("root", "pa", F.col("pa").alias("pb"))
    done = None
    while True:
        bits = min(_bits(most), 64 - depth)
        depth += bits
        nodes = save(members.groupBy("root", _prefix(F.col("key"), depth).alias("p"))
                     .agg(F.count(F.lit(1)).alias("n")), "nodes")

        def child(col: str, as_col: str, n: str):
            up = F.shiftrightunsigned("p", bits)
            return nodes.select("root", up.alias(col), F.col("p").alias(as_col),
                                F.col("n").alias(n))

        step = (frontier.join(child("pa", "ca", "na"), ["root", "pa"])
                .join(child("pb", "cb", "nb"), ["root", "pb"])
                .where("ca <= cb")
                .where(F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= budget))
        step = save(step.select("root", F.col("ca").alias("pa"), F.col("cb").alias("pb"),
                                F.greatest("na", "nb").alias("most"),
                                F.lit(depth).alias("depth")), "pairs")
        small = step.where(F.col("most") <= NODE) if depth < 64 else step
        done = small if done is None else done.unionByName(small)
        most = step.agg(F.max("most")).first()[0]
        frontier = step.where(F.col("most") > NODE).select("root", "pa", "pb")
        if depth == 64 or most is None or most <= NODE:
            break
    done = save(done.withColumn("task", F.lit(-1) - F.monotonically_increasing_id()), "pairs")
    parts = None
    depths = [r[0] for r in done.select("depth").distinct().collect()]  # at most 48
    for d in depths:
        keyed = members.withColumn("p", _prefix(F.col("key"), d))
        at = done.where(F.col("depth") == d)
        left = at.select("root", F.col("pa").alias("p"), "task", F.lit(0).alias("side"))
        right = at.where("pa <> pb").select("root", F.col("pb").alias("p"), "task",
                                            F.lit(1).alias("side"))
        part = keyed.join(left.unionByName(right), ["root", "p"]).select(
            "task", (2 * F.col("r") + F.col("side")).alias("side"), "key")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``: rows whose
    fingerprints are linked, directly or through others, share the least doc_id."""
    rows = save(fingerprints(docs, shingle), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    links = save(trie_links(rows.select("fp").distinct(), max_bits), "links")
    label = connected_components(links)
    member = label.join(distinct.withColumnRenamed("fp", "node"), "node")
    least = member.groupBy("label").agg(F.min("rep").alias("component"))
    linked = label.join(least, "label").select(F.col("node").alias("fp"), "component")
    named = distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
