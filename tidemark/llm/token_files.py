"""Token output as Arrow files of equal-length sequences, and reading them back.

Each file is in Arrow's random-access file format. A row is one sequence:

* ``ids``: fixed-size list of ``seq_len`` token ids, 16 bits wide where the
  vocabulary allows, else 32,
* ``mask``: fixed-size list of ``seq_len // 8`` bytes, a bit for each id from the lowest
  on, 0 on padding (only a file's last sequence has any),
* ``docs``: which document has which part: ``(doc_id, at, n, left)``; ``left`` ids of
  that document follow in the next sequences.

Record batches hold ``_BATCH`` sequences each but the last, and columns are not
compressed, so a memory-mapped file gives any sequence and its mask by place and
without copying (:func:`sequence`). Documents follow each other in
ascending ``doc_id`` (ties by text, null first), each ended by ``end_id``.

Writing: a range partition of documents goes to files of its own, which stay
below ``file_tokens`` plus one document. A task reports its files as rows of a
manifest, and only files in the written manifest count, so files of lost or
repeated attempts are never read.

Defined cases: a null text is empty and gives the end id alone; repeated rows
are written each; an empty table gives an empty manifest; extra columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import save, shared_path, shuffle_partitions
from tidemark.llm.tokens import encoded, encoder

MANIFEST = "path string, part int, file int, n_tokens long, n_docs long"
_BATCH = 256  # sequences in a record batch


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def schema(seq_len: int, vocab: int) -> pa.Schema:
    if seq_len % 8:
        raise ValueError("masks are whole bytes: seq_len must be a multiple of 8")
    ids = pa.uint16() if vocab <= 1 << 16 else pa.uint32()
    return pa.schema([
        ("ids", pa.list_(pa.field("id", ids, nullable=False), seq_len)),
        ("mask", pa.list_(pa.field("real", pa.uint8(), nullable=False), seq_len // 8)),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32()),
                                     ("n", pa.int32()), ("left", pa.int32())]))),
    ])


class _Writer:
    """One Arrow file: takes documents, writes full batches of sequences."""

    def __init__(self, path: str, seq_len: int, vocab: int):
        self.path, self.seq_len, self.schema = path, seq_len, schema(seq_len, vocab)
        self.dtype = self.schema.field("ids").type.value_type.to_pandas_dtype()
        filesystem, inner = _open(path)
        filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.sink = filesystem.open_output_stream(inner)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held, self.n_held, self.docs = [], 0, []
        self.n_tokens = self.n_docs = self.written = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.n_tokens, len(ids)))
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        self.n_tokens += len(ids)
        self.n_docs += 1
        whole = _BATCH * self.seq_len
        if self.n_held >= whole:
            self._flush(self.n_held // whole * whole)

    def _flush(self, n: int) -> None:
        """Write the first ``n`` held ids, padded to whole sequences."""
        ids = np.concatenate(self.held)
        self.held, self.n_held = [ids[n:]], len(ids) - n
        rows = -(-n // self.seq_len)
        flat = np.zeros(rows * self.seq_len, self.dtype)
        flat[:n] = ids[:n]
        parts = [[] for _ in range(rows)]
        first, rest = self.written, []
        for doc_id, start, size in self.docs:
            at, end = max(start, first), start + size
            while at < min(end, first + n):
                row = (at - first) // self.seq_len
                stop = min(end, first + (row + 1) * self.seq_len)
                parts[row].append((doc_id, (at - first) % self.seq_len, stop - at,
                                   end - stop))
                at = stop
            if end > first + n:
                rest.append((doc_id, start, size))
        self.docs, self.written = rest, first + n
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=self.schema.field(k).type)
                 for k, x in (("ids", flat), ("mask", np.packbits(np.arange(len(flat)) < n, bitorder="little")))]
        names = ("doc_id", "at", "n", "left")
        docs = [[dict(zip(names, p)) for p in row] for row in parts]
        batch = pa.record_batch([*lists, pa.array(docs, self.schema.field("docs").type)],
                                schema=self.schema)
        for k in range(0, rows, _BATCH):
            self.file.write_batch(batch.slice(k, _BATCH))

    def close(self) -> None:
        if self.n_held:
            self._flush(self.n_held)
        self.file.close()
        self.sink.close()


def write(docs: DataFrame, tokenizer: str, *, end_id: int = 2, seq_len: int = 2048,
          file_tokens: int = 8_000_000) -> DataFrame:
    """Write all of ``docs`` (``doc_id``, ``text``); return the manifest. The width of ids
    follows from the tokenizer's largest one.

    ``start`` in the manifest is the number of ids before a file's first one.
    """
    spark = docs.sparkSession
    folder = shared_path(spark, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, files = TaskContext.get().partitionId(), None, 0
        end = np.array([end_id], np.uint32)
        vocab = max(encoder(tokenizer).max_id, end_id) + 1

        def closed(w):
            w.close()
            return pa.record_batch([pa.array([v], t) for v, t in (
                (w.path, pa.string()), (part, pa.int32()), (files, pa.int32()),
                (w.n_tokens, pa.int64()), (w.n_docs, pa.int64()))],
                names=["path", "part", "file", "n_tokens", "n_docs"])

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), encoded(b.column(1), tokenizer)):
                if out is None:
                    out = _Writer(f"{folder}/part-{part:06d}-{files:05d}-{uuid.uuid4().hex}.arrow",
                                  seq_len, vocab)
                out.add(doc_id, np.concatenate([ids, end]))
                if out.n_tokens >= file_tokens:
                    yield closed(out)
                    out, files = None, files + 1
        if out is not None:
            yield closed(out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    dealt = (rows.repartitionByRange(shuffle_partitions(spark), "doc_id")
             .sortWithinPartitions("doc_id", "text"))
    manifest = save(dealt.mapInArrow(run, MANIFEST), "manifest")
    # One row a file: running totals over the manifest, not over documents.
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before),
                                                   F.lit(0).cast("long")))


def read(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the files of ``manifest``;
    ``ids`` are little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                filesystem, inner = _open(path)
                with filesystem.open_input_file(inner) as source:
                    yield from _documents(pa.ipc.open_file(source), base)

    parts = manifest.select("path", F.col("start")).repartition(
        shuffle_partitions(manifest.sparkSession), "path")
    return parts.mapInArrow(run, "doc_id long, start long, ids binary")


def _documents(reader, base: int) -> Iterator[pa.RecordBatch]:
    """Documents of one file, whose parts follow each other."""
    rows, size, pieces, at = [], 0, [], base
    names = ["doc_id", "start", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.binary()]

    def batch():
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

    for k in range(reader.num_record_batches):
        b = reader.get_batch(k)
        width = b.schema.field("ids").type.list_size
        flat = b.column("ids").flatten().to_numpy(zero_copy_only=True)
        for row, parts in enumerate(b.column("docs").to_pylist()):
            for p in parts:
                first = row * width + p["at"]
                pieces.append(flat[first:first + p["n"]].astype("<u4").tobytes())
                if p["left"] == 0:
                    ids, pieces = b"".join(pieces), []
                    rows.append((p["doc_id"], at, ids))
                    at += len(ids) // 4
                    size += len(ids)
                    if size > 8_000_000:
                        yield batch()
                        rows, size = [], 0
    if rows:
        yield batch()


def sequence(path: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask bits (views of the mapped file) of sequence ``k`` of a local file;
    ``numpy.unpackbits(mask, bitorder="little")`` has a number for each id."""
    reader = pa.ipc.open_file(pa.memory_map(path.removeprefix("file://")))
    if not 0 <= k // _BATCH < reader.num_record_batches:
        raise IndexError(k)
    b, at = reader.get_batch(k // _BATCH), k % _BATCH
    if at >= b.num_rows:
        raise IndexError(k)
    row = b.slice(at, 1)
    return tuple(row.column(c).flatten().to_numpy(zero_copy_only=True) for c in ("ids", "mask"))
