import random
import re

import numpy as np
import xxhash

from tests.llm.conftest import rows, words
from tidemark.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reference(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(t)
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, max_bits=3):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in parent}


def check(df, out):
    src = [(r["doc_id"], r["text"]) for r in df.collect()]
    fp = [(i, reference(t)) for i, t in src]
    root = components({f for _, f in fp})
    least = {}
    for i, f in fp:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    expected = sorted(((i, f, least.get(root[f])) for i, f in fp), key=str)
    got = sorted(((i, f % 2 ** 64, c) for i, f, c in map(tuple, out.collect())), key=str)
    assert got == expected


def test_odd_rows_and_clashing_columns(odd, clashing):
    check(odd, simhash.near_duplicates(odd))
    assert rows(simhash.near_duplicates(clashing)) == rows(simhash.near_duplicates(odd))


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


def test_near_copies_link(frame):
    rng = random.Random(4)
    base = words(rng, 300)
    docs = [(100 + k, " ".join(base[:50 + k] + ["changed"] + base[51 + k:])) for k in range(40)]
    docs += [(k, " ".join(words(rng, rng.randint(1, 60)))) for k in range(60)]
    df = frame(docs)
    check(df, simhash.near_duplicates(df))


def test_trie_links_of_crowded_blocks(spark, monkeypatch):
    """Nodes are split over tasks; the links still connect what brute force connects."""
    monkeypatch.setattr(simhash, "NODE", 8)
    rng = random.Random(2)
    fps = set()
    for c in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 6)):
                f ^= 1 << b
            fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.trie_links(spark.createDataFrame(signed, "fp long")).collect()
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        a, b = r["a"] % 2 ** 64, r["b"] % 2 ** 64
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert {f: find(f) for f in fps} == components(fps)


def test_a_crowded_root_is_split_by_need(spark, monkeypatch):
    """Somewhat more keys than a node holds are copied a few times, not by the hundred."""
    rng, n = random.Random(6), 2 * simhash.NODE + 100
    keys = [(rng.getrandbits(48),) for _ in range(n)]  # one root: equal first 16 bits
    members = spark.createDataFrame(keys, "key long").selectExpr("0L AS root", "0 AS r", "key")
    tasks = simhash._split(members, 16, 3, n)
    assert n <= tasks.count() <= 12 * n
    assert tasks.select("task").distinct().count() <= 40
    sizes = tasks.groupBy("task", "side").count().agg({"count": "max"}).first()[0]
    assert sizes <= simhash.NODE
    assert [simhash._bits(k * simhash.NODE) for k in (1.1, 2, 5, 10 ** 6)] == [1, 1, 3, 8]


def test_walk_equals_all_pairs():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64))
    i, j = simhash.walk(keys, [(0, len(keys), 0, len(keys))], 0, 2)
    got = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    expected = {(a, b) for a in range(len(keys)) for b in range(a + 1, len(keys))
                if int(keys[a] ^ keys[b]).bit_count() <= 2}
    assert got == expected
