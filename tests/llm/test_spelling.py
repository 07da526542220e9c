import collections
import itertools
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES, odd_rows, rows, words
from tidemark.llm import spelling

LOW = str.maketrans(spelling._UPPER, spelling._LOWER)


def counted(docs):
    n = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(n):
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(((-n[v], v) for v in vs), default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


def run(df):
    found = spelling.corpus_words(df, change=spelling.dropped_letter)
    return rows(spelling.variants(found).select("word", "form", "root", "n", "n_near", "form_n"))


def test_matches_brute_force(frame):
    rng = random.Random(4)
    base = [w for w in words(rng, 200, ("ba", "ko", "ré", "tu", "mñn", "s")) if len(w) > 4] + ["ÀÉÎõü" * 2, "aaaaaa", "aaaaaaa"]
    slips = {}
    for w in base:  # slips of the pen, and slips in copying them
        for _ in range(4):
            v = rng.choice([w, *slips.get(w, [])])
            at = rng.randrange(len(v))
            slips.setdefault(w, []).append(rng.choice(
                (v[:at] + v[at + 1:], v[:at] + "e" + v[at:], v[:at] + "o" + v[at + 1:], v.upper())))
    docs = [(i, " ".join(rng.choice(slips[w]) if rng.random() < 0.4 else w
                         for w in rng.choices(base, k=40))) for i in range(250)]
    n = counted(docs)
    expected = brute(n)
    assert any(r[1] and r[2] != r[1] for r in expected) and len(n) > 300
    assert run(frame(docs)) == expected


def test_odd_rows(odd, clashing, empty, frame):
    docs = [r[:2] for r in odd_rows()]
    assert run(odd) == run(clashing.withColumns({c: F.lit("x") for c in ("word", "n", "key")})) \
        == brute(counted(docs))
    assert run(empty) == []
    long = [(i, "é" * 3000 + " " + "é" * 3001 + " ab " + "abcde" * 700) for i in range(4)]
    assert run(frame(long)) == brute(counted(long))


def test_words_of_any_length_meet(spark):
    """Short and long words take different ways; pairs across the border are found."""
    rng = random.Random(8)
    base = ["".join(rng.choices("abcé", k=n)) for n in (4, 5, 7, 8, 9, 10, 20, 63, 64, 65, 66, 200)]
    table = {w + t: rng.randint(1, 9) for w in base for t in ("", "a", "b", "bb")}
    df = spark.createDataFrame(list(table.items()), "word string, n long")
    expected = {(a, b) for a in table for b in table if is_near(a, b)}
    for border in (6, 8, 64):
        got = spelling.near_pairs(df, long_word=border).select("a", "b").collect()
        assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_ties_and_short_words(spark):
    table = [("kappe", 4), ("kappa", 8), ("kappo", 8), ("kapp", 8), ("ab", 3), ("abc", 9), ("", 1)]
    found = rows(spelling.variants(spark.createDataFrame(table, "word string, n long")))
    by = {r[0]: r for r in found}
    assert by["kappe"][1:] == ("kapp", "kapp", 4, 3, 8)  # equal counts: the smallest word
    assert by["kappa"][1:] == (None, "kappa", 8, 3, None)
    assert by["ab"][4] == by["abc"][4] == by[""][4] == 0


def test_roots_of_long_ways(spark):
    ways = [(f"w{k:02d}", f"w{k + 1:02d}") for k in range(37)]
    got = rows(spelling.roots(spark.createDataFrame(ways, "word string, form string")))
    assert got == [(a, "w37") for a, _ in ways]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=2, max_size=9), st.integers(1, 3), st.integers(1, 3),
       st.randoms())
def test_choice_costs_least(cost, need, width, rng):
    places = sorted(rng.sample(range(20), len(cost)))
    got = spelling.choose_disjoint(places, cost, need, width)
    best = min((sum(cost[i] for i in c) for c in itertools.combinations(range(len(cost)), need)
                if all(places[b] - places[a] >= width for a, b in zip(c, c[1:]))), default=None)
    if best is None:
        assert got == []
    else:
        assert sum(cost[i] for i in got) == best and len(got) == need
        assert all(places[b] - places[a] >= width for a, b in zip(got, got[1:]))


@settings(max_examples=300, deadline=None)
@given(st.text("abé", min_size=4, max_size=9), st.integers(0, 9), st.sampled_from("idr"),
       st.sampled_from("abcé"), st.integers(0, 99))
def test_near_words_share_a_key(word, at, how, letter, seed):
    at = min(at, len(word) - 1)
    other = {"i": word[:at] + letter + word[at:], "d": word[:at] + word[at + 1:],
             "r": word[:at] + letter + word[at + 1:]}[how]
    if other == word or len(other) < 4:
        return
    grams = spelling.Grams(np.random.default_rng(seed).integers(0, 4, 1 << 16))
    pairs = [(spelling.pivot_keys(a, grams), spelling.prefix_keys(b, grams))
             for a, b in ((word, other), (other, word))]
    assert any(p[0] <= g[0] and set(p[1]) & set(g[1]) for p, g in pairs)
