import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows, words
from tidemark.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    first = {}
    for i, t in docs:
        w = WORD.findall(t or "")
        for s in range(len(w) - 12):
            k = tuple(w[s:s + 13])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        w, gone = WORD.findall(t or ""), set()
        for s in range(len(w) - 12):
            if i is not None and first[tuple(w[s:s + 13])] < i:
                gone.update(range(s, s + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


def planted(seed, n):
    rng = random.Random(seed)
    shared = [words(rng, k) for k in (12, 13, 14, 30, 80)]
    docs = []
    for d in rng.sample(range(10 * n), n):
        w = words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(shared)
        docs.append((d, rng.choice((" ", "\n", " \t ")).join(w)))
    return docs


@pytest.mark.parametrize("crowded", [3, 200_000])
def test_planted_passages(frame, crowded):
    docs = planted(7, 60)
    assert rows(substring_dedup.dedup(frame(docs), crowded)) == brute(docs)


def test_repetitive_words(frame):
    """Few different words: crowded prefixes, windows that overlap themselves."""
    rng = random.Random(8)
    docs = [(k, " ".join(rng.choices(["a", "b"], weights=[9, 1], k=60))) for k in range(40)]
    assert rows(substring_dedup.dedup(frame(docs), 4)) == brute(docs)


def test_odd_rows(odd, clashing, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows(substring_dedup.dedup(odd)) == brute(docs)
    assert rows(substring_dedup.dedup(clashing)) == brute(docs)
    assert substring_dedup.dedup(empty).count() == 0


def test_partitions_follow_the_data(spark, monkeypatch, odd):
    """More windows than a task holds go to more partitions; the result stays."""
    before = rows(substring_dedup.dedup(odd))
    monkeypatch.setattr(substring_dedup, "GROUP", 500)
    assert substring_dedup._groups(odd, F.octet_length("text") / 20) > 4
    assert rows(substring_dedup.dedup(odd)) == before
