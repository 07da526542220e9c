"""Hashed n-gram features and logistic regression on them, in numpy.

Families: words and word pairs, runs of three and of four bytes. A text's
feature is the share of its family's n-grams that fall into a slot, so short
and long texts are alike. Nothing here depends on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa

from tidemark.llm.flat import Flat, rolling, slices

BITS = 18
_K = np.array([1, 40503, 2246822519, 3266489917], np.uint32)
FAMILIES = 4


def _char_slots(data: np.ndarray, n: int) -> np.ndarray:
    """Slot of each run of ``n`` bytes."""
    if len(data) < n:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        h = data[:len(data) - n + 1].astype(np.uint32)
        for k in range(1, n):
            h += data[k:len(data) - n + 1 + k].astype(np.uint32) * _K[k]
        h = (h + np.uint32(n)) * np.uint32(2654435761)
    return (h >> np.uint32(32 - BITS)).astype(np.int64)


def families(flat: Flat):
    """``(slots, first, last)`` of each family: text ``k`` has ``slots[first[k]:last[k]]``."""
    starts, ends, bounds = flat.words()
    hashes = flat.word_hashes(starts, ends)
    for n in (1, 2):
        h = hashes if n == 1 else rolling(hashes, 2)
        yield ((h >> np.uint64(64 - BITS)).astype(np.int64), bounds[:-1],
               np.maximum(bounds[:-1], bounds[1:] - n + 1))
    for n in (3, 4):
        first = flat.offsets[:-1]
        yield _char_slots(flat.data, n), first, np.maximum(first, flat.offsets[1:] - n + 1)


class Platt:
    """Calibration ``p = sigmoid(a * score + b)`` fitted by Newton steps; the
    targets are smoothed, so separable scores stay finite."""

    def __init__(self, scores: np.ndarray, y: np.ndarray):
        self.a, self.b = 1.0, 0.0
        if not len(scores):
            return
        pos, neg = y.sum(), len(y) - y.sum()
        t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        x = np.stack([scores, np.ones(len(scores))], 1)
        w = np.array([1.0 / (scores.std() + 1e-9), 0.0])
        for _ in range(50):
            p = sigmoid(x @ w)
            h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
            step = np.linalg.solve(h, x.T @ (p - t))
            w -= np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
        self.a, self.b = float(w[0]), float(w[1])

    def moved(self, y: np.ndarray, shares: tuple[int, int]) -> Platt:
        """From the label shares of the calibration rows ``y`` to those of all
        labelled rows, ``shares`` = (zeros, ones)."""
        ones = y.sum()
        self.b += float(np.log((shares[1] + 1) / (shares[0] + 1))
                        - np.log((ones + 1) / (len(y) - ones + 1)))
        return self

    def __call__(self, scores: np.ndarray) -> np.ndarray:
        return sigmoid(self.a * scores + self.b)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def flat_rows(rows: Sequence, size: int = 1 << 21) -> Iterator[tuple]:
    """``(which, row, slot, value)`` of consecutive rows of about ``size`` slots together."""
    part, n, first = [], 0, 0
    for k in range(len(rows)):
        part.append(rows[k])
        n += len(part[-1][0])
        if n >= size or k + 1 == len(rows):
            yield (slice(first, k + 1), np.repeat(np.arange(len(part)), [len(s) for s, _ in part]),
                   np.concatenate([s for s, _ in part]), np.concatenate([v for _, v in part]))
            part, n, first = [], 0, k + 1


class Logistic:
    """Sparse logistic regression: rows are a sequence of ``(slots, values)``, read
    a part at a time."""

    def __init__(self, size: int):
        self.w = np.zeros(size, np.float32)
        self.b = 0.0

    def fit(self, rows: Sequence, y: np.ndarray, rounds: int = 80,
            rate: float = 0.3, l2: float = 1e-6) -> Logistic:
        """Adagrad on the full batch, classes weighted alike."""
        y = np.asarray(y, float)
        weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
        size = len(self.w)
        w, b = np.zeros(size), 0.0
        g2, gb2 = np.full(size, 1e-12), 1e-12
        few = list(islice(flat_rows(rows), 2))  # one part is kept, more are read each round
        for _ in range(rounds):
            g, gb = l2 * w, 0.0
            for which, row, slot, value in few if len(few) < 2 else flat_rows(rows):
                z = np.bincount(row, value * w[slot], which.stop - which.start) + b
                err = (sigmoid(z) - y[which]) * weight[which]
                g += np.bincount(slot, value * err[row], size)
                gb += err.sum()
            g2 += g * g
            w -= rate * g / np.sqrt(g2)
            gb2 += gb ** 2
            b -= rate * gb / gb2 ** 0.5
        self.w[:] = w
        self.b = float(b)
        return self

    def score(self, rows: Sequence) -> np.ndarray:
        return np.array([float(v.astype(float) @ self.w[s]) + self.b for s, v in rows])


def rows(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training rows of whole texts: slots (by family) with their shares."""
    out = []
    for _, part in slices(pa.array(texts, pa.string()), 1_000_000):
        flat = Flat(part)
        fams = list(families(flat))
        for k in range(flat.n):
            slots, shares = [], []
            for f, (s, first, last) in enumerate(fams):
                got, n = np.unique(s[first[k]:last[k]], return_counts=True)
                slots.append(got + (f << BITS))
                shares.append(n / max(n.sum(), 1))
            out.append((np.concatenate(slots), np.concatenate(shares)))
    return out


def packed(row: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, bytes]:
    return row[0].astype(np.int32).tobytes(), row[1].astype(np.float32).tobytes()


def unpacked(slots: bytes, shares: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(slots, np.int32), np.frombuffer(shares, np.float32)


def text_scores(flat: Flat, model: Logistic) -> np.ndarray:
    """Uncalibrated scores of all texts of a slice, every n-gram counted."""
    z = np.full(flat.n, model.b)
    for f, (slots, first, last) in enumerate(families(flat)):
        w = model.w[f << BITS:(f + 1) << BITS]
        total = np.r_[0.0, np.cumsum(w[slots], dtype=np.float64)]
        z += (total[last] - total[first]) / np.maximum(last - first, 1)
    return z


def text_model_size() -> int:
    return FAMILIES << BITS
