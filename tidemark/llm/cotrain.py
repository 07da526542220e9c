"""Quality classifier by co-training of two views of a document.

The text view is a logistic regression on hashed n-grams of the content
(:mod:`tidemark.llm.ngrams`). The metadata view sees none of the text: it is a
logistic regression on source, language, size class and their pairs.

Training: a bounded sample of labelled rows (``per_class`` of each label, chosen
by a hash of the doc_id, whole texts of any length). In each round both views are
fitted and calibrated on labelled rows that they do not learn from; then every
unlabelled document is scored in tasks by both, and each view labels those it is
surest of (``SURE``), taken in turn from every source and language. They join the
*other* view's training rows with that label; only they reach the driver, at most
``each_round`` a label, view and round and at most ``pool`` rows a round. At the
end the calibrated log-odds of both views, less the sample's, are added to those
of all labelled rows, and all documents are scored.

A view that cannot tell the classes apart is calibrated to the prior: it is
never sure, gives no pseudo-labels and adds nothing to the sum.

Defined cases: null text, source, language or size count as a value of their
own; without labelled rows of both classes every score is 0.5 and every row is
kept; rows whose crc32 of the doc_id is 0 modulo 5 are ``held_out`` of all
learning; rows without a doc_id are scored and not learned from; of unlabelled
rows of one doc_id the surest counts; repeated rows are returned each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.flat import Flat, slices
from tidemark.llm.langid import remainder
from tidemark.llm.quality_rules import label_shares, labelled_sample, with_ngrams
from tidemark.llm.sample import Records, Some, bring, in_order

META_BITS = 14
ROUNDS = 4
SURE = 0.95
THRESHOLD = 0.5
#: Who labels, and how.
KINDS = (("text", 1), ("text", 0), ("meta", 1), ("meta", 0))
_COLUMNS = ["text", "lang", "source", "n_chars"]


def size_class(n_chars) -> str:
    return "-" if n_chars is None else str(int(math.log2(max(n_chars, 0) + 1) * 2))


def metadata_row(lang, source, n_chars) -> tuple[np.ndarray, np.ndarray]:
    """Hashed slots of a document's metadata."""
    return _slots(lang, source, size_class(n_chars))


def _slots(lang, source, size: str) -> tuple[np.ndarray, np.ndarray]:
    parts = (f"l{lang}", f"s{source}", f"n{size}", f"l{lang}|n{size}", f"s{source}|l{lang}")
    slots = [xxhash.xxh64_intdigest(p) >> (64 - META_BITS) for p in parts]
    got, n = np.unique(np.array(slots, np.int64), return_counts=True)
    return got, n.astype(float)


class View:
    """One view: its rows, its training set, its model and calibration."""

    def __init__(self, rows: Sequence, size: int, y: np.ndarray, train: np.ndarray,
                 check: np.ndarray, l2: float):
        self.rows, self.size, self.y, self.check, self.l2 = rows, size, y, check, l2
        self.train = {int(k): int(y[k]) for k in train}
        self.taken = []  # doc_ids that this view has labelled for the other one

    def fit(self) -> None:
        at = sorted(self.train)
        self.model = ngrams.Logistic(self.size).fit(
            Some(self.rows, at), np.array([self.train[k] for k in at]), l2=self.l2)
        score = self.model.score(Some(self.rows, self.check))
        self.platt = ngrams.Platt(score, self.y[self.check])
        # A calibration that turns the score round means that it tells nothing.
        if self.platt.a < 0:
            self.platt.a = 0.0
            share = np.clip(self.y[self.check].mean(), 1e-3, 1 - 1e-3)
            self.platt.b = float(np.log(share / (1 - share)))


class CoTrained:
    """Both trained views, and how many pseudo-labels each gave."""

    def __init__(self, labelled: list, texts: Some, shares: tuple[int, int],
                 surest: Callable, fetch: Callable):
        """``surest`` gives the documents to label, ``fetch`` adds their texts' n-grams
        to ``texts`` and returns their other fields."""
        self.text = self.meta = None
        self.given = {"text": 0, "meta": 0}
        y = np.array([r["_y"] for r in labelled])
        n = len(y)
        if n == 0 or y.min() == y.max():
            return
        meta = [metadata_row(r["lang"], r["source"], r["n_chars"]) for r in labelled]
        check = np.flatnonzero(np.arange(n) % 4 == 0)
        train = np.flatnonzero(np.arange(n) % 4 != 0)
        if len(set(y[check])) < 2 or len(set(y[train])) < 2:
            check = train = np.arange(n)
        self.prior = float(np.clip(y[check].mean(), 1e-3, 1 - 1e-3))
        self.base = float(np.log((shares[1] + 1) / (shares[0] + 1)))
        views = {"text": View(texts, ngrams.text_model_size(), y, train, check, 1e-6),
                 "meta": View(meta, 1 << META_BITS, y, train, check, 1e-3)}
        others = {"text": "meta", "meta": "text"}
        place = {}
        for k in range(ROUNDS + 1):
            for v in views.values():
                v.fit()
            self.text = (views["text"].model, views["text"].platt)
            self.meta = (views["meta"].model, views["meta"].platt)
            chosen = surest(self, {name: v.taken for name, v in views.items()}) if (
                k < ROUNDS) else []
            if not chosen:
                break
            new = {(r["doc_id"], r["key"]) for r in chosen} - place.keys()
            for r in fetch(sorted(new)):
                place[r["doc_id"], r["key"]] = len(meta)
                meta.append(metadata_row(r["lang"], r["source"], r["n_chars"]))
            for r in chosen:
                name, label = KINDS[r["kind"]]
                views[others[name]].train[place[r["doc_id"], r["key"]]] = label
                views[name].taken.append(r["doc_id"])
                self.given[name] += 1

    def views(self, flat: Flat, meta: list) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of good quality by the text and the metadata view."""
        kinds = [(lang, source, size_class(n)) for lang, source, n in meta]
        known = {k: j for j, k in enumerate(dict.fromkeys(kinds))}  # scored once each
        each = self.meta[1](self.meta[0].score([_slots(*k) for k in known]))
        return (self.text[1](ngrams.text_scores(flat, self.text[0])),
                each[[known[k] for k in kinds]])

    def scores(self, flat: Flat, meta: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: text view, metadata view, both."""
        if self.text is None:
            half = np.full(flat.n, 0.5)
            return half, half, half
        pt, pm = self.views(flat, meta)

        def odds(p):
            return np.log(np.clip(p, 1e-9, 1 - 1e-9) / np.clip(1 - p, 1e-9, 1))

        return pt, pm, ngrams.sigmoid(
            odds(pt) + odds(pm) - 2 * odds(np.float64(self.prior)) + self.base)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 5) == 0, F.lit(False))


def _with_metadata(docs: DataFrame) -> DataFrame:
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(
        (F.col(c) if c in docs.columns else F.lit(None)).cast(t).alias(c)
        for c, t in kinds.items()))


def surest_rows(docs: DataFrame, known: DataFrame, model: CoTrained, taken: dict,
                each: int) -> DataFrame:
    """At most ``each`` rows ``(kind, doc_id, key)`` of each of ``KINDS``: of all documents
    of ``docs`` but ``known`` and, by view, ``taken`` ones, the surest of every source and
    language, then the next ones."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model, {name: np.array(ids, np.int64) for name, ids in taken.items()}))  # about 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, gone = shared.value
        for b in batches:
            meta = list(zip(*(b.column(c).to_pylist() for c in (2, 3, 4))))
            for k, texts in slices(b.column(1)):
                n = len(texts)
                ids = b.column(0).slice(k, n).to_numpy()
                p = [np.where(np.isin(ids, gone[name]), 0.5, x) for name, x in zip(
                    ("text", "meta"), net.views(Flat(texts), meta[k:k + n]))]
                yield pa.record_batch([*(b.column(c).slice(k, n) for c in (0, 5, 2, 3)),
                                       *map(pa.array, p)],
                                      names=["doc_id", "key", "lang", "source", "text", "meta"])

    scored = docs.where("doc_id IS NOT NULL").withColumn(
        "key", F.xxhash64(*_COLUMNS)).mapInArrow(
        run, "doc_id long, key long, lang string, source string, text double, meta double")

    def best(kind: int) -> Column:
        name, label = KINDS[kind]
        # Rounded, so that the order does not hang on how texts are batched.
        sure = F.round(F.col(name) if label else 1 - F.col(name), 6)
        return F.max(F.when(sure >= SURE, F.struct(
            F.lit(kind).alias("kind"), sure.alias("sure"), "key", "source", "lang")))

    found = (scored.groupBy("doc_id").agg(*(best(k).alias(f"k{k}") for k in range(len(KINDS))))
             .join(known, "doc_id", "left_anti")
             .select("doc_id", F.explode(F.array(*(f"k{k}" for k in range(len(KINDS)))))
                     .alias("best")).where("best IS NOT NULL").select("doc_id", "best.*"))
    order = [F.desc("sure"), F.xxhash64("doc_id"), "doc_id"]
    # Both windows keep each task's first rows before their shuffle (`each` is small).
    turn = Window.partitionBy("kind", "source", "lang").orderBy(*order)
    rank = Window.partitionBy("kind").orderBy("turn", *order)
    return (found.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= each)
            .withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= each)
            .select("kind", "doc_id", "key"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1200, pool: int = 2000,
          each_round: int = 200) -> CoTrained:
    # Held-out rows count nowhere, not in the labels' shares either.
    labels = labels.where(~held_out(F.col("doc_id")))
    docs = _with_metadata(docs).where(~held_out(F.col("doc_id")))
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id").distinct()
    each = min(each_round, max(1, pool // len(KINDS)))
    store, long = Records(ngrams.unpacked), ["slots", "shares"]
    labelled = bring(with_ngrams(labelled_sample(docs, labels, "quality", per_class, _COLUMNS)),
                     "sample", long, store)
    labelled, texts = in_order(labelled, store, "doc_id", "_y")

    def surest(model: CoTrained, taken: dict) -> list:
        got = surest_rows(docs, known, model, taken, each).collect()
        return sorted(got, key=lambda r: (r["kind"], r["doc_id"]))

    def fetch(new: list) -> list:
        if not new:
            return []
        ids = docs.sparkSession.createDataFrame(new, "doc_id long, key long")
        rows = (docs.withColumn("key", F.xxhash64(*_COLUMNS))
                .join(F.broadcast(ids), ["doc_id", "key"])  # at most pool rows
                .dropDuplicates(["doc_id", "key"]))
        before = len(store)
        got, more = in_order(bring(with_ngrams(rows), "sample", long, store),
                             store, "doc_id", "key")
        texts.at += [before + k for k in more.at]
        return got

    return CoTrained(labelled, texts, label_shares(labels, "quality"), surest, fetch)


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``(doc_id, held_out, text_score, metadata_score, score, kept)`` of every row."""
    rows = _with_metadata(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 4 MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = list(zip(*(b.column(c).to_pylist() for c in (2, 3, 4))))
            for k, texts in slices(b.column(1)):
                n = len(texts)
                pt, pm, p = shared.value.scores(Flat(texts), meta[k:k + n])
                yield pa.record_batch(
                    [b.column(0).slice(k, n), b.column(5).slice(k, n), pa.array(pt),
                     pa.array(pm), pa.array(p), pa.array(p >= THRESHOLD)],
                    names=["doc_id", "held_out", "text_score", "metadata_score", "score", "kept"])

    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        run, "doc_id long, held_out boolean, text_score double, metadata_score double, "
             "score double, kept boolean")
