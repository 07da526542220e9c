"""Training samples on the driver's disk.

A sample has a bounded number of rows but no bound on a row's length: its long
fields lie in an unnamed temporary file and are read when they are used, so the
driver's memory holds places and short fields only.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame

from tidemark.llm.common import discard, save


#: A label's rows are ranked in so many parts at most, each by itself.
PARTS = 16


def parts(bound: int) -> int:
    """Parts for a sample of ``bound`` rows: its first ``bound // parts`` rows by hash of
    each part make the sample. No task sorts all rows of a label, and tasks drop what
    cannot be chosen before the shuffle."""
    return min(PARTS, max(1, bound // 60))


class Records(Sequence):
    """Byte records in a file; ``read`` makes an item of a record's parts."""

    def __init__(self, read: Callable):
        self.read, self.places, self.end = read, [], 0
        self.file = tempfile.TemporaryFile(buffering=0)

    def add(self, *parts: bytes) -> None:
        at = [self.end]
        for p in parts:
            self.file.write(p)
            at.append(at[-1] + len(p))
        self.places.append(at)
        self.end = at[-1]

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, k: int):
        at = self.places[k]
        raw = os.pread(self.file.fileno(), at[-1] - at[0], at[0])
        return self.read(*(raw[a - at[0]:b - at[0]] for a, b in zip(at, at[1:])))


class Some(Sequence):
    """The items ``at`` of ``items``, read when they are used."""

    def __init__(self, items: Sequence, at):
        self.items, self.at = items, [int(k) for k in at]

    def __len__(self) -> int:
        return len(self.at)

    def __getitem__(self, k: int):
        return self.items[self.at[k]]


def rows_of(df: DataFrame, tag: str) -> Iterator:
    """The rows of ``df``, made in parallel and brought a partition at a time."""
    saved = save(df, tag)
    yield from saved.toLocalIterator()
    discard(saved)


def bring(df: DataFrame, tag: str, long: list[str], into: Records) -> list:
    """Add the fields ``long`` of all rows of ``df`` to ``into``; the other fields
    are returned, in the same order."""
    short = []
    for r in rows_of(df, tag):
        into.add(*(bytes(r[c]) for c in long))
        short.append({k: v for k, v in r.asDict().items() if k not in long})
    return short


def in_order(short: list, items: Sequence, *keys: str) -> tuple[list, Some]:
    """Both sorted by the fields ``keys``."""
    order = sorted(range(len(short)), key=lambda k: tuple(short[k][c] for c in keys))
    return [short[k] for k in order], Some(items, order)
