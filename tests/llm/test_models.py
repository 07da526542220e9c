"""Held-out accuracy of the trained operators, and counts against brute force."""
import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, rows
from tidemark.llm import cotrain, langid, ngrams, quality_rules, queries, toxicity

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def test_language_held_out_accuracy(spark):
    got = queries.op3_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id")
    right = held.where("lang = lang_pred").count() / held.count()
    assert right > 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_odd_rows(spark, odd, clashing, empty):
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"), F.lit(True), per_lang=60)
    out = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()}
    und = {i for i, lang, s in out if lang == "und"}
    assert {1, 2, 3, 4} <= und and all(s == 0 for i, lang, s in out if lang == "und")
    assert rows(langid.predict(clashing, model)) == rows(langid.predict(odd, model))
    assert langid.predict(odd, model).count() == odd.count()
    assert langid.train(empty, F.lit(True)) is None
    assert langid.predict(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


def test_language_needs_a_letter(spark, frame):
    """Digits in other forms, and letters that are numbers, are no letters."""
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"), F.lit(True), per_lang=60)
    texts = ["½ 12 ² ① Ⅷ", "!? 1_2", "½ a ½", "ª", "٣", "我"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"])
           for r in langid.predict(frame(list(enumerate(texts))), model).collect()}
    assert [got[k][0] == "und" for k in range(6)] == [True, True, False, False, True, False]
    assert all((lang == "und") == (score == 0) for lang, score in got.values())


def test_language_forward_pass(spark, frame):
    """Probabilities by a plain re-statement of the network."""
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"), F.lit(True), per_lang=60)
    texts = ["the words of a text " * 30, "de la", "é"]

    def window(raw):
        feats = []
        for k, w in enumerate(langid.WIDTHS):
            best = np.zeros(langid.FILTERS)
            for at in range(langid.WINDOW - w + 1):
                v = model.bias[k] + sum(model.tables[k][j][raw[at + j]] for j in range(w))
                best = np.maximum(best, v)
            feats.append(best)
        z = np.concatenate(feats) @ model.dense + model.dense_bias
        e = np.exp(z - z.max())
        return e / e.sum()

    got = {r["doc_id"]: r for r in langid.predict(frame(list(enumerate(texts))), model).collect()}
    for k, t in enumerate(texts):
        raw, total, size = t.encode(), 0, 0
        for at in range(0, len(raw), langid.WINDOW):
            part = raw[at:at + langid.WINDOW]
            total = total + window(part.ljust(langid.WINDOW, b"\0")) * len(part)
            size += len(part)
        p = total / size
        assert got[k]["lang_pred"] == model.classes[p.argmax()]
        assert got[k]["score"] == pytest.approx(p.max(), abs=1e-3)


def test_language_gradients():
    """The filters learn: training lowers the loss on separable windows."""
    rng = np.random.default_rng(0)
    x = rng.integers(97, 105, (400, langid.WINDOW)).astype(np.uint8)
    y = np.arange(400) % 2
    x[y == 1, 40:43] = np.frombuffer(b"xyz", np.uint8)
    net = langid.ByteCNN(["a", "b"]).fit(x, y, steps=60)
    assert (net.probabilities(x).argmax(axis=1) == y).mean() > 0.98


def brute_counts(t):
    w = WORD.findall(t or "")
    c = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    again = set()
    for k in range(len(w) - 4):
        if c[tuple(w[k:k + 5])] > 1:
            again.update(range(k, k + 5))
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")),
            len(lines) - len(set(lines)), len(again))


def test_quality_counts(spark, odd, clashing, empty, frame):
    none = labels(spark, [])
    extra = frame([(1, "a b c d e f a b c d e"), (2, "x\ny\nx\n\n \nx # * | <"),
                   (3, "é ß\U0001f600 w " * 9), (4, "a " * 30), (5, " a b c d e x a b c d")])
    for df in (odd, extra):
        out = quality_rules.assess(df, quality_rules.train(df, none))
        got = sorted((tuple(r)[:6] for r in out.collect()), key=str)
        assert got == sorted(((r["doc_id"], *brute_counts(r["text"])) for r in df.collect()),
                             key=str)
        for r in out.collect():
            failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
            assert r["base_failed"] == failed and r["kept"] == (not failed)
    model = quality_rules.train(odd, none)
    assert rows(quality_rules.assess(clashing, model)) == rows(quality_rules.assess(odd, model))
    assert quality_rules.assess(empty, model).count() == 0


def held_out_quality(spark):
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    held = lab.where(langid.remainder(F.col("doc_id"), 5) == 0)
    return lab.join(held, "doc_id", "left_anti"), held


def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learn, held = held_out_quality(spark)
    out = quality_rules.assess(docs, quality_rules.train(docs, learn)).join(held, "doc_id")
    assert out.where("kept = (quality = 1)").count() / out.count() > 0.93
    again = quality_rules.assess(docs, quality_rules.train(docs, learn)).join(held, "doc_id")
    assert rows(again.select("doc_id", "probability")) == rows(out.select("doc_id", "probability"))


def test_cotraining(spark, odd, clashing, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    model = cotrain.train(docs, lab, per_class=150, pool=200)
    assert model.given["text"] > 0  # views do exchange labels
    out = cotrain.score(docs, model).join(lab, "doc_id").where("held_out")
    assert out.where("kept = (quality = 1)").count() / out.count() > 0.9
    assert rows(cotrain.score(odd, model)) == rows(cotrain.score(clashing, model))
    assert cotrain.score(odd, model).count() == odd.count()
    assert cotrain.score(empty, model).count() == 0
    blank = cotrain.train(odd, labels(spark, []))
    assert {(r["score"], r["kept"]) for r in cotrain.score(odd, blank).collect()} == {(0.5, True)}


def toxic_sample(n, seed=0):
    rng = np.random.default_rng(seed)
    vocab = [f"wo{k}" for k in range(40)]
    texts, y = [], []
    for k in range(n):
        w = list(rng.choice(vocab, int(rng.integers(40, 120))))
        if k % 2:
            for _ in range(2):
                w[int(rng.integers(len(w)))] = str(rng.choice(["nasty", "vile"]))
        texts.append(" ".join(w))
        y.append(k % 2)
    return texts, np.array(y)


def test_toxicity_learns_and_gradients_are_right():
    texts, y = toxic_sample(160)
    net = toxicity.BiGRU(*toxicity.vocabulary(texts, y))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    some, label = texts[:4], y[:4]

    def loss():
        w = toxicity.Words(pa.array(some))
        index, first = w.windows()
        z = net.window_logits(w, index).astype(float)
        s = np.bincount(np.repeat(np.arange(4), np.diff(first)), np.logaddexp(0, z), 4)
        return float(np.mean(np.where(label > 0, -np.log(-np.expm1(-s)), s)))

    g = net._gradients(some, label)
    for name, v in net.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = v[at]
        v[at] = old + 1e-3
        up = loss()
        v[at] = old - 1e-3
        down = loss()
        v[at] = old
        assert abs((up - down) / 2e-3 - g[name][at]) < 1e-3 + 0.05 * abs(g[name][at]), name
    net = toxicity.BiGRU(*toxicity.vocabulary(texts, y)).fit(texts, y, steps=150)
    new, yn = toxic_sample(100, seed=1)
    z = net.text_logits(pa.array(new))
    assert z[yn == 1].min() > z[yn == 0].max() - 2 and np.mean(
        z[yn == 1][:, None] > z[yn == 0]) > 0.97


def test_toxicity_windows_cover_every_word():
    w = toxicity.Words(pa.array(["", "a", " ".join(map(str, range(1000, 1200))), "... ?!"]))
    index, first = w.windows()
    assert list(np.diff(first)) == [0, 1, 8, 0]
    assert set(index[1:9].ravel()) - {-1} == set(w.codes[1:].tolist())


def test_toxicity_odd_rows(spark, odd, clashing, empty, frame):
    texts, y = toxic_sample(60)
    lab = labels(spark, [(k, 1, int(v)) for k, v in enumerate(y)])
    model = toxicity.train(frame(list(enumerate(texts))), lab, F.lit(True), per_class=30)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert out[1] == out[2] == out[3] == out[4] == 0 and all(0 <= s <= 1 for s in out.values())
    assert rows(toxicity.score(clashing, model)) == rows(toxicity.score(odd, model))
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(empty, lab, F.lit(True)) is None
    assert {r["score"] for r in toxicity.score(odd, None).collect()} == {0.0}


def test_calibration_is_between_the_shares():
    rng = np.random.default_rng(1)
    y = (rng.random(4000) < 0.3).astype(int)
    p = ngrams.Platt(rng.normal(size=4000) + 2 * y, y)(np.array([-2.0, 1.0, 4.0]))
    assert p[0] < 0.05 and 0.2 < p[1] < 0.6 and p[2] > 0.95


def test_samples_hold_long_texts(spark, frame):
    """A label whose texts are all long is learned as well, from the whole texts."""
    texts, y = toxic_sample(60)
    long = [f"{t} " * 60 if v else t for t, v in zip(texts, y)]
    assert min(len(t) for t, v in zip(long, y) if v) > 8000
    docs = frame(list(enumerate(long)))
    lab = labels(spark, [(k, int(v), int(v)) for k, v in enumerate(y)])
    got = quality_rules.labelled_sample(docs, lab, "toxic", 1000, ["text"]).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == list(enumerate(long))
    p = {r["doc_id"]: r["score"] for r in toxicity.score(
        docs, toxicity.train(docs, lab, F.lit(True))).collect()}
    assert np.mean([(p[k] > 0.5) == v for k, v in enumerate(y)]) > 0.9
    p = {r["doc_id"]: r["probability"] for r in quality_rules.assess(
        docs, quality_rules.train(docs, lab)).collect()}
    assert np.mean([(p[k] > 0.5) == v for k, v in enumerate(y)]) > 0.9


def test_toxicity_gradients_by_parts(monkeypatch):
    texts, y = toxic_sample(20)
    net = toxicity.BiGRU(*toxicity.vocabulary(texts, y))
    whole = net._gradients(texts, y)
    monkeypatch.setattr(toxicity, "MOST", 7)
    for name, v in net._gradients(texts, y).items():
        assert np.allclose(v, whole[name], atol=1e-5), name


def test_cotraining_forward_pass(spark):
    """The final score by a plain re-statement: both views' calibrated log-odds added."""
    import math
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    model = cotrain.train(docs, lab, per_class=60, pool=40)
    rows = docs.limit(25).collect()

    def calibrated(platt, z):
        return 1 / (1 + math.exp(-(platt.a * z + platt.b)))

    def odds(p):
        return math.log(p / (1 - p))

    got = {r["doc_id"]: r for r in cotrain.score(docs, model).collect()}
    for r in rows:
        (slots, shares), = ngrams.rows([r["text"]])
        text, platt = model.text
        pt = calibrated(platt, sum(float(text.w[s]) * v for s, v in zip(slots, shares)) + text.b)
        meta, platt = model.meta
        slots, n = cotrain.metadata_row(r["lang"], r["source"], r["n_chars"])
        pm = calibrated(platt, sum(float(meta.w[s]) * v for s, v in zip(slots, n)) + meta.b)
        z = odds(pt) + odds(pm) - 2 * odds(model.prior) + model.base
        own = got[r["doc_id"]]
        assert own["text_score"] == pytest.approx(pt, abs=1e-4)
        assert own["metadata_score"] == pytest.approx(pm, abs=1e-4)
        assert own["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def test_cotraining_prior_ignores_held_out_labels(spark):
    """Turned labels of held-out rows change nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    turned = lab.withColumn("quality", F.when(cotrain.held_out(F.col("doc_id")), F.lit(0))
                            .otherwise(F.col("quality")))
    a, b = (cotrain.train(docs, x, per_class=60, pool=40) for x in (lab, turned))
    assert a.base == b.base and (a.text[0].w == b.text[0].w).all()


def test_cotraining_looks_at_all_unlabelled_documents(spark):
    """A source far behind in the order of hashes is labelled and learned too."""
    texts, y = toxic_sample(600)
    ids = [r[0] for r in spark.range(240, 600).orderBy(F.xxhash64("id")).collect()]
    rare = set([k for k in ids if y[k]][-20:])  # of one label, else its weight stays 0
    texts = [t + " nasty vile" * 20 if k in rare else t for k, t in enumerate(texts)]
    docs = spark.createDataFrame([(k, t, "xx", "rare" if k in rare else "s", len(t))
                                  for k, t in enumerate(texts)], DOCS)
    lab = labels(spark, [(k, int(v), 0) for k, v in enumerate(y[:240])])
    model = cotrain.train(docs, lab, pool=8)
    slot = cotrain.xxhash.xxh64_intdigest("srare") >> (64 - cotrain.META_BITS)
    assert model.given["text"] > 0 and model.meta[0].w[slot] != 0
