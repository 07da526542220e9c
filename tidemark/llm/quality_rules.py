"""Quality rules: counts with fixed limits, and a classifier's verdict.

Counts of a text: words, code points in words, symbols, repeated lines, words
in repeated 5-word windows. The classifier is a logistic regression on hashed
word and character n-grams (:mod:`tidemark.llm.ngrams`), trained on a bounded
sample of labelled rows (``per_class`` rows of each label, chosen by a hash of
the doc_id, whole texts of any length: their n-grams are counted in tasks and
lie on the driver's disk, see :mod:`tidemark.llm.sample`), with Platt calibration on a fifth of the sample that is not trained on, moved to the label
shares of all labelled rows. Whole texts are
scored in Arrow batches; a text is kept if it passes the counts and its
probability reaches ``THRESHOLD``.

Defined cases: a null text is empty: no words, fails the word limit; without
labelled rows of both classes the counts alone decide; repeated rows are
returned each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.flat import Flat, rolling, runs_inside, slices
from tidemark.llm.sample import Records, Some, bring, in_order, parts

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
THRESHOLD = 0.5
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_LINE_SPACE = " \t\r\x0b\x0c"


def per_text(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[k]:last[k]]``."""
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return total[last] - total[first]


def repeated_words(hashes: np.ndarray, bounds: np.ndarray, window: int = 5) -> np.ndarray:
    """Per text the number of words in windows found twice or more in that text."""
    runs = rolling(hashes, window)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(runs)]
    inside = np.flatnonzero(runs_inside(bounds, len(hashes), window))
    key = runs[inside] ^ (owner[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    twice = np.zeros(len(key), bool)
    twice[order] = np.r_[same, False] | np.r_[False, same] if len(key) else False
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, inside[twice], 1)
    np.add.at(edge, inside[twice] + window, -1)
    return per_text(np.cumsum(edge[:-1]) > 0, bounds[:-1], bounds[1:])


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(_LINE_SPACE)]
    return len(lines) - len(set(lines))


def counts(texts: pa.Array, flat: Flat) -> dict[str, np.ndarray]:
    starts, ends, bounds = flat.words()
    lead = (flat.data & 0xC0) != 0x80  # the first byte of each code point
    lead &= ~np.isin(flat.data, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
    at = flat.offsets
    return {
        "n_words": np.diff(bounds),
        "word_chars": per_text(lead, at[:-1], at[1:]),
        "n_symbols": per_text(_SYMBOL[flat.data], at[:-1], at[1:]),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts.to_pylist()], np.int64),
        "n_repeat_words": repeated_words(flat.word_hashes(starts, ends), bounds),
    }


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    columns: list[str]) -> DataFrame:
    """At most ``per_class`` rows of each label: ``doc_id``, the given document
    columns, the label ``_y``."""
    # Only ids are shuffled; the chosen ids are few, so texts stay in place.
    known = (docs.where(F.col("doc_id").isNotNull()).select("doc_id")
             .join(labels.where(F.col(label).isin(0, 1))
                   .select("doc_id", F.col(label).cast("int").alias("_y")), "doc_id").distinct())
    # A label's rows are ranked in parts by hash; each task keeps its first ones of a part
    # before the shuffle. So no label is a hot key.
    rank = Window.partitionBy("_y", F.pmod(F.xxhash64("doc_id"), F.lit(parts(per_class)))).orderBy(
        F.xxhash64("doc_id"), "doc_id")
    chosen = (known.withColumn("_nth", F.row_number().over(rank))
              .where(F.col("_nth") <= per_class // parts(per_class)).select("doc_id", "_y"))
    one = Window.partitionBy("doc_id", "_y").orderBy(*columns)
    return (docs.select("doc_id", *columns)
            .join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class rows
            .withColumn("_nth", F.row_number().over(one)).where("_nth = 1").drop("_nth"))


def with_ngrams(rows: DataFrame) -> DataFrame:
    """``rows`` with the n-grams of the whole ``text`` (``slots``, ``shares``) in its stead."""
    place = rows.columns.index("text")
    out = rows.drop("text").withColumns({c: F.lit(b"") for c in ("slots", "shares")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, texts in slices(b.column(place), 1_000_000):
                got = [ngrams.packed(r) for r in ngrams.rows(texts.to_pylist())]
                part = b.slice(k, len(texts))
                yield pa.record_batch(
                    [*(c for j, c in enumerate(part.columns) if j != place),
                     *(pa.array(x, pa.binary()) for x in zip(*got))], names=out.names)

    return rows.withColumn("text", F.col("text").cast("string")).mapInArrow(run, out)


def label_shares(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many rows have label 0 and 1."""
    got = labels.groupBy(F.col(label).cast("int").alias("y")).count().where("y IN (0, 1)")
    n = {r["y"]: r["count"] for r in got.collect()}
    return n.get(0, 0), n.get(1, 0)


class Quality:
    """The trained classifier; ``None`` weights mean that there was nothing to learn."""

    def __init__(self, rows: Sequence, y: np.ndarray, shares: tuple[int, int]):
        self.model = self.platt = None
        if not len(y) or y.min() == y.max():
            return
        held = np.arange(len(y)) % 5 == 0
        if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
            held = np.zeros(len(y), bool)
        self.model = ngrams.Logistic(ngrams.text_model_size()).fit(
            Some(rows, np.flatnonzero(~held)), y[~held])
        check = held if held.any() else ~held
        self.platt = ngrams.Platt(
            self.model.score(Some(rows, np.flatnonzero(check))), y[check]
        ).moved(y[check], shares)

    def __call__(self, flat: Flat) -> np.ndarray:
        if self.model is None:
            return np.ones(flat.n)
        return self.platt(ngrams.text_scores(flat, self.model))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1504) -> Quality:
    rows = Records(ngrams.unpacked)
    got = bring(with_ngrams(labelled_sample(docs, labels, "quality", per_class, ["text"])),
                "sample", ["slots", "shares"], rows)
    got, rows = in_order(got, rows, "doc_id", "_y")
    return Quality(rows, np.array([r["_y"] for r in got]), label_shares(labels, "quality"))


def assess(docs: DataFrame, model: Quality) -> DataFrame:
    """Counts, ``base_failed``, ``probability`` and ``kept`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, texts in slices(b.column(1)):
                flat = Flat(texts)
                c = counts(texts, flat)
                failed = (c["n_words"] < MIN_WORDS) | (
                    100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                p = shared.value(flat)
                yield pa.record_batch(
                    [b.column(0).slice(k, flat.n), *map(pa.array, c.values()),
                     pa.array(failed), pa.array(p), pa.array(~failed & (p >= THRESHOLD))],
                    names=["doc_id", *c, "base_failed", "probability", "kept"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, "
                                "n_dup_lines long, n_repeat_words long, base_failed boolean, "
                                "probability double, kept boolean")
