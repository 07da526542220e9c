"""Toxicity by a bidirectional gated recurrent network over words and characters.

A word's input is its word vector next to the mean of its hashed character
trigram vectors. Words of at least ``MIN_DOCS`` documents of the sample have a
vector, which starts from log-odds of counts; all others share one. A window is
``SPAN`` words, the next one starts ``STRIDE`` words on, so neighbours overlap;
every window of every text is scored. Over a window one network reads forwards
and one backwards, attention pools their states, and a linear layer gives the
window's logit. A text's logit is its windows' greatest, made a probability by
Platt calibration.

Training (numpy, Adam): a document is toxic if any window is, so the loss is
that of a noisy "or" over all its windows. The sample is bounded: ``per_class``
labelled documents of each label, chosen by a hash of the doc_id among the
learnable ones, whole texts of any length; a fifth of them only calibrates.
The texts lie on the driver's disk (:mod:`tidemark.llm.sample`), and a step goes
through at most ``MOST`` windows at once.

Defined cases: a null or wordless text has score 0; so has every text if there
is nothing to learn from; repeated rows are returned each; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.flat import Flat, slices
from tidemark.llm.ngrams import Platt, _char_slots, sigmoid
from tidemark.llm.quality_rules import label_shares, labelled_sample
from tidemark.llm.sample import Records, Some, bring, in_order

SPAN, STRIDE = 32, 24
HIDDEN, WORD_DIM, CHAR_DIM, ATT = 8, 8, 8, 8
MIN_DOCS, CHAR_BITS = 5, 12
#: Windows that a training step holds the states of.
MOST = 4096
_PUNCT = ".,;:!?\"'()[]{}*#$%&|<>"


class Words:
    """A slice of texts as word numbers with the hashed inputs of distinct words."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        code = lists.flatten().dictionary_encode()
        flat = Flat(pc.utf8_trim(code.dictionary, characters=_PUNCT))
        size = np.diff(flat.offsets)
        some = np.flatnonzero(size)
        self.hash = np.zeros(flat.n, np.uint64)
        self.hash[some] = flat.word_hashes(flat.offsets[:-1][some], flat.offsets[1:][some])
        self.grams = _char_slots(flat.data, 3) >> (18 - CHAR_BITS)
        self.first = np.minimum(flat.offsets[:-1], len(self.grams))
        self.last = np.maximum(self.first, np.minimum(flat.offsets[1:] - 2, len(self.grams)))
        real = np.zeros(flat.n, bool)
        real[some] = True
        codes = code.indices.to_numpy()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        keep = real[codes] if len(codes) else np.empty(0, bool)
        total = np.r_[0, np.cumsum(keep)]
        self.codes, self.bounds = codes[keep].astype(np.int64), total[bounds]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """``(index, first)``: word numbers of all windows, -1 as padding; text
        ``k`` has the windows ``first[k]:first[k + 1]``."""
        n = np.diff(self.bounds)
        count = np.where(n > 0, 1 + -(-np.maximum(n - SPAN, 0) // STRIDE), 0)
        first = np.r_[0, np.cumsum(count)]
        nth = np.arange(first[-1]) - np.repeat(first[:-1], count)
        start = np.repeat(self.bounds[:-1], count) + nth * STRIDE
        at = start[:, None] + np.arange(SPAN)
        inside = at < np.repeat(self.bounds[1:], count)[:, None]
        index = np.where(inside, self.codes[np.minimum(at, len(self.codes) - 1)], -1) if len(
            self.codes) else np.empty((0, SPAN), np.int64)
        return index, first


def batches(texts: Sequence, size: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts ``(first, texts)`` of about ``size`` characters."""
    part, n, first = [], 0, 0
    for k in range(len(texts)):
        part.append(texts[k])
        n += len(part[-1])
        if n >= size or k + 1 == len(texts):
            yield first, part
            part, n, first = [], 0, k + 1


def vocabulary(texts: Sequence, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words of at least ``MIN_DOCS`` texts and a hundredth of
    them, and for each how much likelier a toxic text has it (smoothed log-odds)."""
    got, n, one = np.empty(0, np.uint64), np.empty(0), np.empty(0)
    for first, part in batches(texts):
        w = Words(pa.array(part, pa.string()))
        owner = np.repeat(np.arange(len(part)), np.diff(w.bounds))
        pairs = np.unique(np.stack([w.hash[w.codes], owner.astype(np.uint64)], 1), axis=0)
        got, at = np.unique(np.r_[got, pairs[:, 0]], return_inverse=True)
        n = np.bincount(at, np.r_[n, np.ones(len(pairs))], len(got))
        one = np.bincount(at, np.r_[one, y[first + pairs[:, 1].astype(np.int64)]], len(got))
    odds = (np.log((one + 0.5) / (y.sum() + 1))
            - np.log((n - one + 0.5) / (len(y) - y.sum() + 1)))
    often = n >= max(MIN_DOCS, len(texts) // 100)
    return got[often], odds[often]


class BiGRU:
    """The network; ``p`` holds its arrays."""

    def __init__(self, vocab: np.ndarray, odds: np.ndarray, seed: int = 3):
        self.vocab = vocab
        rng = np.random.default_rng(seed)
        x, h = WORD_DIM + CHAR_DIM, HIDDEN

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": normal(len(vocab) + 1, WORD_DIM, scale=0.1),
            "char": normal(1 << CHAR_BITS, CHAR_DIM, scale=0.1),
            "att": normal(2 * h, ATT, scale=0.3), "att_v": normal(ATT, scale=0.3),
            "out": normal(2 * h, scale=0.3), "out_b": np.array([-3.0], np.float32),
        }
        # Word vectors start from what counting knows; training goes on from there.
        self.p["word"][1:, 0] = np.clip(odds, -4, 4) / 2
        for d in "fb":
            self.p |= {f"W{d}": normal(x, 3 * h, scale=x ** -0.5),
                       f"U{d}": normal(h, 3 * h, scale=h ** -0.5),
                       f"B{d}": np.zeros(3 * h, np.float32)}
        self.platt: Platt | None = None

    def rows(self, w: Words) -> np.ndarray:
        """Row of each distinct word in the word table; 0 for unknown words."""
        if not len(self.vocab):
            return np.zeros(len(w.hash), np.int64)
        at = np.minimum(np.searchsorted(self.vocab, w.hash), len(self.vocab) - 1)
        return np.where(self.vocab[at] == w.hash, at + 1, 0)

    def inputs(self, w: Words) -> np.ndarray:
        """Input vectors of the distinct words."""
        total = np.zeros((len(w.grams) + 1, CHAR_DIM))
        np.cumsum(self.p["char"][w.grams], axis=0, out=total[1:])
        n = np.maximum(w.last - w.first, 1)[:, None]
        char = (total[w.last] - total[w.first]) / n
        return np.concatenate([self.p["word"][self.rows(w)], char.astype(np.float32)], axis=1)

    def _run(self, d: str, proj: np.ndarray, index: np.ndarray, keep: list | None = None):
        """States (time, window, HIDDEN) of one direction; ``keep`` takes what the
        backward pass needs. Row -1 of ``proj`` stands for padding."""
        u, h3 = self.p[f"U{d}"], HIDDEN
        h = np.zeros((len(index), h3), np.float32)
        states = np.empty((SPAN, len(index), h3), np.float32)
        for t in range(SPAN) if d == "f" else reversed(range(SPAN)):
            x = proj[index[:, t]]
            hu = h @ u
            gates = 1 / (1 + np.exp(-(x[:, :2 * h3] + hu[:, :2 * h3])))
            z, r = gates[:, :h3], gates[:, h3:]
            n = np.tanh(x[:, 2 * h3:] + r * hu[:, 2 * h3:])
            real = (index[:, t] >= 0)[:, None]
            new = np.where(real, n + z * (h - n), h)
            if keep is not None:
                keep.append((t, h, z, r, n, hu[:, 2 * h3:], real))
            states[t] = h = new
        return states

    def _projected(self, x: np.ndarray, d: str) -> np.ndarray:
        return np.concatenate([x @ self.p[f"W{d}"] + self.p[f"B{d}"],
                               np.zeros((1, 3 * HIDDEN), np.float32)]).astype(np.float32)

    def _pooled(self, states: np.ndarray, index: np.ndarray):
        u = np.tanh(states @ self.p["att"])
        e = u @ self.p["att_v"]
        e = np.where(index.T >= 0, e, -np.inf)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        return u, a, np.einsum("tn,tnh->nh", a, states)

    def window_logits(self, w: Words, index: np.ndarray) -> np.ndarray:
        x = self.inputs(w)
        pf, pb = self._projected(x, "f"), self._projected(x, "b")
        out = np.empty(len(index), np.float32)
        for k in range(0, len(index), 2048):
            i = index[k:k + 2048]
            states = np.concatenate([self._run("f", pf, i), self._run("b", pb, i)], axis=2)
            out[k:k + 2048] = self._pooled(states, i)[2] @ self.p["out"] + self.p["out_b"]
        return out

    def text_logits(self, texts: pa.Array) -> np.ndarray:
        """Greatest window logit of each text, ``-inf`` without words."""
        w = Words(texts)
        index, first = w.windows()
        out = np.full(len(texts), -np.inf)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            out[full] = np.maximum.reduceat(self.window_logits(w, index), first[full])
        return out

    def _forward(self, proj: dict, index: np.ndarray) -> tuple:
        """What the backward pass needs of the windows ``index``, their logits last."""
        kept = {d: [] for d in "fb"}
        states = np.concatenate([self._run(d, proj[d], index, kept[d]) for d in "fb"], axis=2)
        u, a, pooled = self._pooled(states, index)
        return kept, states, u, a, pooled, pooled @ self.p["out"] + self.p["out_b"]

    def _backward(self, forward: tuple, index: np.ndarray, dl: np.ndarray, x: np.ndarray,
                  g: dict, dx: np.ndarray) -> None:
        """Add the gradients of the windows ``index`` to ``g`` and of their inputs to ``dx``."""
        p = self.p
        kept, states, u, a, pooled, _ = forward
        g["out"] += dl @ pooled
        g["out_b"] += dl.sum()
        dpool = dl[:, None] * p["out"]
        dstates = a[:, :, None] * dpool
        da = np.einsum("nh,tnh->tn", dpool, states)
        de = a * (da - (a * da).sum(axis=0))
        du = de[:, :, None] * p["att_v"] * (1 - u * u)
        g["att_v"] += np.einsum("tn,tna->a", de, u)
        g["att"] += np.einsum("tnh,tna->ha", states, du)
        dstates += du @ p["att"].T
        # Steps of one word are summed; steps of padding are left out.
        flat = index.T.ravel()
        order = np.argsort(flat, kind="stable")[np.count_nonzero(flat < 0):]
        words, begins = np.unique(flat[order], return_index=True)
        for k, d in enumerate("fb"):
            dg = np.zeros((SPAN, len(index), 3 * HIDDEN), np.float32)
            dh = np.zeros((len(index), HIDDEN), np.float32)
            for t, h, z, r, n, hun, real in reversed(kept[d]):
                dh = dh + dstates[t, :, k * HIDDEN:(k + 1) * HIDDEN]
                dnew = np.where(real, dh, 0)
                dn = dnew * (1 - z) * (1 - n * n)
                dz = dnew * (h - n) * z * (1 - z)
                dr = dn * hun * r * (1 - r)
                dg[t] = np.concatenate([dz, dr, dn], axis=1)
                dhu = np.concatenate([dz, dr, dn * r], axis=1)
                g[f"U{d}"] += h.T @ dhu
                dh = np.where(real, dnew * z, dh) + dhu @ p[f"U{d}"].T
            dproj = np.zeros((len(x), 3 * HIDDEN))
            dproj[words] = np.add.reduceat(dg.reshape(-1, 3 * HIDDEN)[order], begins)
            g[f"B{d}"] += dproj.sum(axis=0)
            g[f"W{d}"] += x.T @ dproj
            dx += dproj @ p[f"W{d}"].T

    def _gradients(self, texts: list[str], y: np.ndarray, rng=None, drop: float = 0.0) -> dict:
        """Gradients of the mean loss; a share ``drop`` of words lacks its characters
        and one of known words counts as unknown, so that neither is learned by heart."""
        p = self.p
        w = Words(pa.array(texts, pa.string()))
        index, first = w.windows()
        rows, x = self.rows(w), self.inputs(w)
        seen = np.ones(len(x), bool) if rng is None else rng.random(len(x)) >= drop
        x[~seen, WORD_DIM:] = 0
        if rng is not None:
            unknown = rng.random(len(x)) < drop / 5
            rows[unknown] = 0
            x[unknown, :WORD_DIM] = p["word"][0]
        proj = {d: self._projected(x, d) for d in "fb"}
        cuts = range(0, len(index), MOST)
        # Noisy or: 1 - P(toxic) = product of (1 - sigmoid(logit)), over all windows of a text.
        count = np.diff(first)
        owner = np.repeat(np.arange(len(texts)), count)
        once = self._forward(proj, index) if len(cuts) < 2 else None
        logit = once[-1] if once else np.concatenate(
            [self._forward(proj, index[k:k + MOST])[-1] for k in cuts])
        s = np.bincount(owner, np.logaddexp(0, logit), len(texts))
        slope = np.where(y > 0, -1 / np.expm1(np.maximum(s, 1e-6)), 1.0) / len(texts)
        dl = (slope[owner] * sigmoid(logit)).astype(np.float32)
        g = {name: np.zeros_like(v) for name, v in p.items()}
        dx = np.zeros(x.shape)
        for k in cuts:
            i = index[k:k + MOST]
            self._backward(once or self._forward(proj, i), i, dl[k:k + MOST], x, g, dx)
        np.add.at(g["word"], rows, dx[:, :WORD_DIM])
        dx[~seen] = 0
        size = w.last - w.first
        each = np.repeat(dx[:, WORD_DIM:] / np.maximum(size, 1)[:, None], size, axis=0)
        at = np.arange(int(size.sum())) + np.repeat(w.first - (np.cumsum(size) - size), size)
        np.add.at(g["char"], w.grams[at], each)
        return g

    def fit(self, texts: Sequence, y: np.ndarray, steps: int = 400, batch: int = 32,
            rate: float = 0.01, decay: float = 0.05, drop: float = 0.5,
            seed: int = 9) -> BiGRU:
        rng = np.random.default_rng(seed)
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        while step < steps:
            order = rng.permutation(len(texts))
            for k in range(0, len(texts), batch):
                part = order[k:k + batch]
                g = self._gradients([texts[i] for i in part], y[part], rng, drop)
                norm = sum(float((v * v).sum()) for v in g.values()) ** 0.5
                step += 1
                lr = rate * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
                for name, v in self.p.items():
                    d = g[name].astype(np.float32) * min(1, 5 / (norm + 1e-9))
                    a, b = m[name]
                    a += 0.1 * (d - a)
                    b += 0.001 * (d * d - b)
                    v -= lr * (a / (np.sqrt(b) + 1e-8) + decay * v * (name != "out_b"))
        return self


def train(docs: DataFrame, labels: DataFrame, learnable: Column,
          per_class: int = 1008) -> BiGRU | None:
    """A calibrated network from labelled rows where ``learnable``, or None.

    The sample holds both labels alike; the calibration is moved to their shares
    among all learnable rows.
    """
    labels = labels.where(learnable & F.col("toxic").isin(0, 1))
    texts = Records(lambda raw: raw.decode(errors="replace"))
    rows = labelled_sample(docs, labels, "toxic", per_class, ["text"]).withColumn(
        "text", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    got, texts = in_order(bring(rows, "sample", ["text"], texts), texts, "doc_id", "_y")
    worded = [k for k in range(len(got)) if texts[k].split()]
    texts, y = Some(texts, worded), np.array([got[k]["_y"] for k in worded])
    if not len(y) or y.min() == y.max():
        return None
    held = np.arange(len(y)) % 5 == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    learn = Some(texts, np.flatnonzero(~held))
    net = BiGRU(*vocabulary(learn, y[~held])).fit(learn, y[~held])
    check = held if held.any() else ~held
    z = np.concatenate([net.text_logits(pa.array(part, pa.string()))
                        for _, part in batches(Some(texts, np.flatnonzero(check)))])
    some = np.isfinite(z)
    yc = y[check][some]
    net.platt = Platt(z[some], yc).moved(yc, label_shares(labels, "toxic"))
    return net


def score(docs: DataFrame, model: BiGRU | None) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs``, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # under 1 MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            for k, texts in slices(b.column(1)):
                p = np.zeros(len(texts))
                if net is not None:
                    z = net.text_logits(texts)
                    some = np.isfinite(z)
                    p[some] = net.platt(z[some])
                yield pa.record_batch([b.column(0).slice(k, len(texts)), pa.array(p)],
                                      names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
