"""A batch of texts as flat byte arrays: words, word hashes, n-gram hashes.

Words are runs of bytes other than ASCII white space. A word's 64-bit hash is a
sum of random numbers, one per byte and place, so different words get equal
hashes with probability 2^-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20240611).integers(1, 1 << 63, (32, 256), np.uint64) * 2 + 1
_RANDOM_FLAT = _RANDOM.ravel()
_MIX = np.uint64(0x9E3779B97F4A7C15)


#: glibc's call that returns free heap pages; other C libraries have none.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what an earlier slice or task of this reused worker needed to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(texts: pa.Array, size: int = 4_000_000) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts ``(first, texts)`` of about ``size`` bytes; null is empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    k = 0
    while k < len(texts):
        give_back()
        done = total[k - 1] if k else 0
        stop = max(k + 1, int(np.searchsorted(total, done + size, "right")))
        yield k, texts.slice(k, stop - k)
        k = stop


class Flat:
    """Texts of one slice end to end in ``data``; text ``k`` is
    ``data[offsets[k]:offsets[k + 1]]``."""

    def __init__(self, texts: pa.Array):
        _, offsets, data = texts.buffers()
        off = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
        off = off.astype(np.int64)
        self.data = (np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None
                     else np.empty(0, np.uint8))
        self.offsets = off - off[0]
        self.n = len(texts)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(starts, ends, bounds)``: byte places of all words; text ``k`` has
        the words ``bounds[k]:bounds[k + 1]``."""
        inside = ~_SPACE[self.data]
        edge = np.empty(len(inside) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        edge[self.offsets] = True
        at = np.flatnonzero(edge)
        starts, ends = at[:-1], at[1:]
        keep = inside[starts] if len(starts) else np.empty(0, bool)
        starts, ends = starts[keep], ends[keep]
        return starts, ends, np.searchsorted(starts, self.offsets)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each word."""
        out = np.empty(len(starts), np.uint64)
        for k in range(0, len(starts), 100_000):  # bounds the arrays with a number per byte
            out[k:k + 100_000] = self._hashes(starts[k:k + 100_000], ends[k:k + 100_000])
        return out

    def _hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - starts
        before = np.cumsum(size) - size
        place = np.arange(int(size.sum()), dtype=np.int64)
        at = place + np.repeat(starts - before, size)
        place -= np.repeat(before, size)
        value = _RANDOM_FLAT[((place & 31) << 8) + self.data[at]]
        if int(size.max()) > 32:
            value = value * (2 * (place >> 5) + 1).astype(np.uint64)
        h = np.add.reduceat(value, before) + size.astype(np.uint64)
        h *= _MIX
        return h ^ (h >> np.uint64(29))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive hashes (as if one text)."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = hashes[n - 1:].copy()
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(1, n):
            factor = factor * _MIX
            out += hashes[n - 1 - k:len(hashes) - k] * factor
    out ^= out >> np.uint64(31)
    out *= _MIX
    return out ^ (out >> np.uint64(32))


def runs_inside(bounds: np.ndarray, total: int, n: int) -> np.ndarray:
    """For each start of a run of ``n`` words of the whole batch: does it lie in one text?"""
    count = max(total - n + 1, 0)
    ok = np.ones(count, bool)
    for b in range(1, n):
        at = bounds[1:-1] - b
        ok[at[(at >= 0) & (at < count)]] = False
    return ok
