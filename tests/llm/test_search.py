import collections
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import rows, words
from tidemark.llm import search

LOW = str.maketrans(search._UPPER, search._LOWER)


def split(t):
    return re.findall(search.TERM_RE, (t or "").translate(LOW))


def brute(docs, items, k=10):
    bags = [(i, collections.Counter(split(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    own, out = collections.defaultdict(set), []
    for i, t in items:
        own[i].update(split(t))
    for i, ts in own.items():
        scores = []
        for d, b, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            s = sum(weight[t] * ((10 ** 9 * b[t]) // (1000 * b[t] + 8 * m)) for t in ts if t in b)
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


def check(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = rows(search.search(d, b, **kw).select("item_id", "rank", "doc_id", "score"))
    assert got == brute(docs, items, kw.get("k", 10))
    return got


def test_matches_brute_force(spark):
    rng = random.Random(3)
    vocabulary = words(rng, 150)
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 80)))) for i in range(600)]
    docs += [(1000 + i, docs[5][1]) for i in range(200)]  # ties beyond the limit
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for i in range(30)]
    whole = check(spark, docs, items, bucket=16)
    # Blocks of items, few focus coordinates and other bucket sizes change nothing.
    assert check(spark, docs, items, block_items=7, focus=1, bucket=64) == whole


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "?! ..."), (4, "Ünder straße x1 x1"), (4, "Ünder straße x1 x1"),
            (None, "x1 STRAßE"), (5, "y " * 30_000 + "x1"), (6, "É é É"), (7, "a\x00b a_b A-B 1.5")]
    items = [(1, "X1, straße!"), (1, "ünder"), (2, None), (3, "--"), (None, "x1 y"), (4, "É b 5"),
             (5, "unknown")]
    check(spark, docs, items)
    check(spark, docs, [], k=3)
    check(spark, [], items)


def test_extra_columns(spark):
    d = spark.createDataFrame([(1, "ab cd"), (2, "cd")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "cd")], "item_id long, text string")
    extra = [F.lit("clash").alias(c) for c in ("n", "terms", "score", "rank", "item", "count")]
    got = search.search(d.select("*", *extra), b.select("*", *extra))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 2


def test_bounds_prune_and_lose_nothing():
    """Most pairs are never scored, none that belongs to the best is left out."""
    rng = np.random.default_rng(5)
    n_terms, n_docs = 400, 4000
    weights = rng.integers(1, 12_000, n_terms)
    items = [rng.choice(n_terms, 12, replace=False) for _ in range(20)]
    queries = search.Queries(list(range(20)), items, weights, focus=8)
    size = rng.integers(1, 40, n_docs)
    term = np.concatenate([rng.choice(n_terms, s, replace=False) for s in size])
    impact = rng.integers(1, 1_000_000, len(term))
    owner = np.repeat(np.arange(n_docs), size)
    length = np.sqrt(np.bincount(owner, impact.astype(float) ** 2, n_docs))
    order, starts = np.argsort(-length, kind="stable"), np.cumsum(size) - size
    best, scored = search.Best(20, 10, np.zeros(20, np.int64)), 0
    for first in range(0, n_docs, 256):
        part = order[first:first + 256]
        at = search._ranges(starts[part], size[part])
        scored += search.search_bucket(queries, best, part, np.r_[0, np.cumsum(size[part])],
                                       term[at], impact[at], length[part])
    for q, item in enumerate(items):
        full = np.zeros(n_terms, np.int64)
        full[item] = weights[item]
        scores = np.bincount(owner, full[term] * impact, n_docs).astype(np.int64)
        exact = np.lexsort((np.arange(n_docs), -scores))[:10]
        assert list(best.docs[q]) == list(exact)
        assert list(best.scores[q]) == list(scores[exact])
    assert scored < 0.5 * n_docs * 20
