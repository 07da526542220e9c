"""Language identification by a byte convolutional network, trained in numpy.

Network: windows of ``WINDOW`` bytes; for each width ``FILTERS`` filters over
one-hot bytes, so a filter is one table of 256 weights per place and a
convolution is a sum of table rows; rectifier; maximum over the window; one
dense layer; softmax. A text's probabilities are the mean over all of its
windows, weighted by their bytes.

Training data: at most ``per_lang`` documents a language, chosen by a hash of
the doc_id among the learnable ones, two passages of ``PASSAGE`` characters
each. This bounded sample is all that reaches the driver.

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text if there is nothing to learn from; repeated rows are returned
each; rows without doc_id are scored and never learned from; an empty table
gives an empty result; extra columns are ignored; a tie goes to the first
language in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.flat import Flat, slices
from tidemark.llm.sample import parts

WINDOW = 128
PASSAGE = 160
WIDTHS = (2, 3, 4)
FILTERS = 16


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the doc_id as text, modulo ``m``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


class ByteCNN:
    """Weights: ``tables[w][j]`` (256 x FILTERS) for place ``j`` of width ``w``."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.tables = [[rng.normal(0, 0.3, (256, FILTERS)).astype(np.float32)
                        for _ in range(w)] for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        size = FILTERS * len(WIDTHS)
        self.dense = rng.normal(0, 0.1, (size, len(classes))).astype(np.float32)
        self.dense_bias = np.zeros(len(classes), np.float32)

    def _convolved(self, x: np.ndarray, k: int) -> np.ndarray:
        w = WIDTHS[k]
        n = x.shape[1] - w + 1
        out = self.tables[k][0].take(x[:, :n], axis=0)
        for j in range(1, w):
            out += self.tables[k][j].take(x[:, j:j + n], axis=0)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of windows ``x`` (n x WINDOW bytes)."""
        out = np.empty((len(x), len(self.classes)), np.float32)
        for k in range(0, len(x), 256):  # small parts stay in the CPU's cache
            part = x[k:k + 256]
            pooled = np.concatenate([np.maximum(self._convolved(part, i).max(axis=1) + b, 0)
                                     for i, b in enumerate(self.bias)], axis=1)
            z = pooled @ self.dense + self.dense_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[k:k + 256] = z / z.sum(axis=1, keepdims=True)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 800, batch: int = 128,
            rate: float = 0.01, seed: int = 11) -> ByteCNN:
        """Adam on cross-entropy; the maximum sends gradients to one place each."""
        rng = np.random.default_rng(seed)
        params = [t for ts in self.tables for t in ts] + self.bias + [self.dense, self.dense_bias]
        m1 = [np.zeros_like(p) for p in params]
        m2 = [np.zeros_like(p) for p in params]
        step = 0
        filters = np.arange(FILTERS)
        while step < steps:
            order = rng.permutation(len(x))
            for k in range(0, len(x), batch):
                xb, yb = x[order[k:k + batch]], y[order[k:k + batch]]
                n = len(xb)
                best, top = [], []
                for i, b in enumerate(self.bias):
                    c = self._convolved(xb, i)
                    at = c.argmax(axis=1)
                    best.append(at)
                    top.append(np.take_along_axis(c, at[:, None], 1)[:, 0] + b)
                pre = np.concatenate(top, axis=1)
                act = np.maximum(pre, 0)
                z = act @ self.dense + self.dense_bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(n), yb] -= 1
                p /= n
                back = (p @ self.dense.T) * (pre > 0)
                grads, biases = [], []
                for i, w in enumerate(WIDTHS):
                    g = back[:, i * FILTERS:(i + 1) * FILTERS]
                    biases.append(g.sum(axis=0))
                    for j in range(w):
                        cell = np.take_along_axis(xb, best[i] + j, 1).astype(np.int64) * FILTERS
                        grads.append(np.bincount((cell + filters).ravel(), g.ravel(),
                                                 256 * FILTERS).reshape(256, FILTERS))
                grads += biases + [act.T @ p, p.sum(axis=0)]
                step += 1
                lr = rate * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
                for q, a, b, g in zip(params, m1, m2, grads):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= (lr * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
        return self


def byte_windows(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, the last of each padded with zero bytes, and the
    number of windows before each text."""
    size = np.diff(flat.offsets)
    count = -(-size // WINDOW)
    first = np.r_[0, np.cumsum(count)]
    out = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    at = np.arange(len(flat.data)) + np.repeat(first[:-1] * WINDOW - flat.offsets[:-1], size)
    out[at] = flat.data
    return out.reshape(-1, WINDOW), first


def train(docs: DataFrame, learnable: Column, per_lang: int = 1504) -> ByteCNN | None:
    """A network from ``docs`` (``doc_id``, ``text``, ``lang``) where ``learnable``."""
    text, size = F.col("text").cast("string"), F.length(F.col("text").cast("string"))

    def passage(salt):
        place = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.greatest(size - PASSAGE, F.lit(1)))
        return F.substring(text, place.cast("int") + 1, F.lit(PASSAGE))

    rows = (docs.where(learnable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                       & text.rlike(r"\p{L}"))
            .select(F.col("lang").cast("string").alias("lang"),
                    F.xxhash64("doc_id").alias("h"), passage(1).alias("a"),
                    passage(2).alias("b")))
    # Each task keeps its first rows of a part before the shuffle, which knows no hot key.
    first = Window.partitionBy("lang", F.pmod("h", F.lit(parts(per_lang)))).orderBy("h", "a")
    got = (rows.withColumn("nth", F.row_number().over(first))
           .where(F.col("nth") <= per_lang // parts(per_lang)).select("lang", "a", "b").collect())
    if not got:
        return None
    got.sort()
    classes = sorted({r["lang"] for r in got})
    rng = np.random.default_rng(5)
    x, y = np.zeros((2 * len(got), WINDOW), np.uint8), np.zeros(2 * len(got), np.int64)
    for k, r in enumerate(got):
        for j, t in enumerate((r["a"], r["b"])):
            raw = t.encode()[:WINDOW]
            if j and rng.random() < 0.5:  # short texts have padded windows
                raw = raw[:int(rng.integers(8, WINDOW))]
            x[2 * k + j, :len(raw)] = np.frombuffer(raw, np.uint8)
            y[2 * k + j] = classes.index(r["lang"])
    return ByteCNN(classes).fit(x, y)


def predict(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row of ``docs``, from its text alone."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return annotate(rows, model).drop("text")


def annotate(docs: DataFrame, model: ByteCNN | None, lang: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """``docs`` as it is with the prediction for ``text`` in two more columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed few hundred KB
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, texts in slices(b.column(place)):
                langs, scores = _predicted(texts, shared.value)
                part = b.slice(k, len(texts))
                yield pa.record_batch(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores)],
                    names=[*b.schema.names, lang, score])

    out = StructType([*docs.schema.fields, StructField(lang, StringType()),
                      StructField(score, DoubleType())])
    return docs.mapInArrow(run, out)


def _predicted(texts: pa.Array, net: ByteCNN | None) -> tuple[list[str], np.ndarray]:
    flat = Flat(texts)
    lang, score = ["und"] * flat.n, np.zeros(flat.n)
    if net is None or not len(flat.data):
        return lang, score
    x, first = byte_windows(flat)
    p = net.probabilities(x) * (x != 0).sum(axis=1, keepdims=True)
    full = np.flatnonzero(np.diff(first))
    total = np.zeros((flat.n, len(net.classes)))
    total[full] = np.add.reduceat(p, first[full], axis=0)
    total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-9)
    best = total.argmax(axis=1)
    for i, t in enumerate(texts.to_pylist()):
        if any(map(str.isalpha, t)):  # a letter in Unicode's sense, as the training's
            lang[i] = net.classes[best[i]]
            score[i] = min(total[i, best[i]], 1.0)
    return lang, score
