"""Spelling variant grouping: words one edit apart by pivotal grams.

``near_pairs`` finds all pairs of distinct words that differ by exactly one
inserted, deleted or replaced code point:

1. Every bigram of a word has a rank, rare bigrams first (ranks are counts of
   2^16 hash buckets, so the table is bounded whatever the alphabet).
2. A word's gram prefix are its three rarest bigrams and all that tie with the
   third. Two of them at least do not overlap; dynamic programming over the
   positions chooses the two disjoint ones with the least total count: the pivots.
3. One edit touches at most one of two disjoint grams, so of two near words the
   one whose prefix ends at the lower rank has a pivot that is in the other's
   prefix. The edit lies before both pivots, in one of them, between or after them;
   in each case a beginning and an end of the word, pivot included, are equal in
   both words, at places that one edit can shift by one (the position limit). A key
   is a hash of these parts with their lengths. So a gram that a third of all words
   hold is split by its place and surroundings.
4. Key matches whose lengths differ by one at most are verified by edit distance
   inside the join; only true pairs leave it.

``variants`` gives each word its form, the near word of largest count (ties: the
smallest in code-point order) if it is at least ``ratio`` times as frequent, and
its root, the last word on the way along forms. Counts at least double on each
step, so ways are short, and roots are found by pointer doubling.

Defined cases: null, empty or letterless texts hold no word; repeated rows count
each; a null doc_id is the empty string in a run's hash; empty tables give an empty
result; extra columns are ignored; words under four code points have no near word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import save

LETTERS = "a-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BUCKETS = 1 << 16
_Q, _EDITS = 2, 1
_MANY = 0x5BD1E995  # tells keys of one pivot alone from those of a word's beginning


def dropped_letter(doc_id: Column, run: Column, every: int = 97) -> Column:
    """``run``, without one code point where ``every`` divides the crc32 of
    ``<doc_id>:<run>`` (the code point that the same number chooses)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    k = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), k), F.substring(
        run, k + 2, F.length(run)))).otherwise(run)


def corpus_words(docs: DataFrame, *, min_chars: int = 5, min_count: int = 3,
                 change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(word, n)``: the words of ``docs`` (letter runs, A-Z lower-cased) with at least
    ``min_chars`` code points and ``min_count`` occurrences. ``change(doc_id, run)`` may
    turn a run into another word, with fewer code points but never more."""
    text = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    # A shorter run cannot become a word, so it is not looked at.
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        text, F.lit(f"([{LETTERS}]{{{min_chars},}})"), F.lit(1))).alias("run"))
    word = change(F.col("doc_id"), F.col("run")) if change else F.col("run")
    # Counts are combined in each task before the shuffle: no word is hot.
    return (runs.select(word.alias("word")).where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often the bigrams of each hash bucket occur in the distinct ``words``."""
    letters = F.split("word", "", -1)  # cut once, so that long words take linear time
    grams = words.where(F.length("word") >= _Q).select(letters.alias("c")).select(F.explode(
        F.transform(F.sequence(F.lit(0), F.size("c") - _Q), lambda i: F.concat(
            *(F.get("c", i + k) for k in range(_Q))))).alias("gram"))
    bucket = (F.crc32("gram") % _BUCKETS).cast("int").alias("bucket")
    out = np.zeros(_BUCKETS, np.int64)
    for r in grams.groupBy(bucket).count().collect():  # at most 2^16 rows
        out[r["bucket"]] = r["count"]
    return out


def choose_disjoint(places: list[int], cost: list[int], need: int, width: int) -> list[int]:
    """Indices of ``need`` grams of ``width`` at rising ``places`` that do not overlap and
    cost least in all, by dynamic programming; empty if there are not so many."""
    # best[k][i]: least cost of k disjoint ones among the first i, and whether i - 1 is one.
    n, far = len(places), 1 << 62
    before = []  # how many of the first grams end at or before the start of gram i
    j = 0
    for i in range(n):
        while places[j] + width <= places[i]:
            j += 1
        before.append(j)
    best = [[(0, False)] * (n + 1)]
    for _ in range(need):
        row = [(far, False)]
        for i in range(n):
            taken = best[-1][before[i]][0] + cost[i]
            row.append((taken, True) if taken < row[i][0] else (row[i][0], False))
        best.append(row)
    if best[need][n][0] >= far:
        return []
    out, i = [], n
    for k in range(need, 0, -1):
        while not best[k][i][1]:
            i -= 1
        out.append(i - 1)
        i = before[i - 1]
    return out[::-1]


class Grams:
    """Ranks and costs of bigrams, from their counts by hash bucket."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.ranks = counts.tolist(), [0] * _BUCKETS
        for k, b in enumerate(np.lexsort((np.arange(_BUCKETS), counts)).tolist()):
            self.ranks[b] = k

    def prefix(self, word: str) -> tuple[int, list[int], list[int]]:
        """``(rank of the prefix's end, places of its grams, their costs)``."""
        buckets = [zlib.crc32(word[i:i + _Q].encode()) % _BUCKETS
                   for i in range(len(word) - _Q + 1)]
        rank = [self.ranks[b] for b in buckets]
        last = sorted(rank)[_Q * _EDITS]
        places = [i for i, r in enumerate(rank) if r <= last]
        return last, places, [self.counts[buckets[i]] for i in places]


def _parts(word: str) -> tuple[list[int], list[int]]:
    """Hashes of the word's beginnings ``[:k]`` and ends ``[k:]``."""
    left, right, h, g = [0], [0], 0, 0
    for c in word:
        h = zlib.crc32(c.encode(), h)
        left.append(h)
    for c in reversed(word):
        g = zlib.crc32(c.encode(), g)
        right.append(g)
    return left, right[::-1]


def _key(left: int, right: int, begin: int, rest: int) -> int:
    """Of a beginning of ``begin`` and an end of ``rest`` code points, with their hashes."""
    h = (left << 29) ^ right ^ (begin * 0x9E3779B97F4A7C15) ^ (rest * 0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    return (h ^ h >> 29) - (1 << 63)


def pivot_keys(word: str, grams: Grams) -> tuple[int, list[int]]:
    """The rank of the prefix's end and, for each place an edit can have beside the two
    pivots, a key of what it leaves alone."""
    last, places, cost = grams.prefix(word)
    p1, p2 = (places[i] for i in choose_disjoint(places, cost, _EDITS + 1, _Q))
    left, right = _parts(word)
    n = len(word)
    return last, [
        _key(0, right[p1], 0, n - p1),                               # before both
        _key(left[p1], right[p1 + _Q], p1, n - p1 - _Q),             # in the first
        _key(left[p1 + _Q], right[p2], p1 + _Q, n - p2),             # between them
        _key(left[p2], right[p2 + _Q], p2, n - p2 - _Q),             # in the second
        _key(left[p2 + _Q], 0, p2 + _Q, 0),                          # after both
        _key(left[p1 + _Q], _MANY, p1 + _Q, 0)]                      # between, see below


def prefix_keys(word: str, grams: Grams) -> tuple[int, list[int]]:
    """The rank of the prefix's end and the keys under which a near word's pivots meet it."""
    last, places, _ = grams.prefix(word)
    left, right = _parts(word)
    n = len(word)
    out = {_key(0, right[i], 0, n - i) for i in places}
    out.update(_key(left[i + _Q], 0, i + _Q, 0) for i in places)
    if len(places) <= 16:
        out.update(_key(left[i + _Q], right[j], i + _Q, n - j)
                   for i in places for j in places if i + _Q <= j)
    else:  # a word of one gram over and over: the first pivot alone, not all pairs
        out.update(_key(left[i + _Q], _MANY, i + _Q, 0) for i in places)
    low, high = places[0] + _Q, places[-1]
    # The other's lost gram has become one to three code points here; a gram of the
    # prefix is left beside them.
    out.update(_key(left[i], right[i + gap], i, n - i - gap)
               for gap in range(_Q - _EDITS, _Q + _EDITS + 1) for i in range(n - gap + 1)
               if low <= i or i + gap <= high)
    return last, list(out)


def _keyed(words: DataFrame, keys: Callable, carried: tuple[str, ...], side: str) -> DataFrame:
    """``key`` and ``<side>_last`` for each key of every word, with the columns ``carried``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                b = whole.slice(first, 1000)
                found = [keys(w) for w in b.column(0).to_pylist()]
                size = [len(k) for _, k in found]
                owner = pa.array(np.repeat(np.arange(len(found)), size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.fromiter((x for _, k in found for x in k), np.int64, sum(size))),
                     pa.array(np.repeat([last for last, _ in found], size), pa.int64()),
                     *(b.column(k + 1).take(owner) for k in range(len(carried)))],
                    names)

    names = ["key", f"{side}_last", *(f"{side}_{c}" for c in carried)]
    types = dict(words.dtypes)
    schema = ", ".join(["key long", f"{side}_last long",
                        *(f"{side}_{c} {types[c]}" for c in carried)])
    return words.select("word", *(F.col(c).alias(f"c{k}") for k, c in enumerate(carried))
                        ).mapInArrow(run, schema)


def near_pairs(words: DataFrame, *, long_word: int = 64) -> DataFrame:
    """``(a, a_n, b, b_n)``: every pair of distinct ``words`` (``word``, ``n``; each word
    once) at edit distance one, in both orders.

    A word has some keys for each of its code points. Words up to ``long_word`` code points
    go with their keys; for longer ones a number does, and they are looked up for the
    pairs that meet.
    """
    grams = Grams(gram_counts(words))
    ways = (partial(pivot_keys, grams=grams), partial(prefix_keys, grams=grams))
    size, far = F.length("word"), F.levenshtein("a_word", "b_word", _EDITS)

    # No key is hot: it holds nearly a whole word. The words' table grows with the corpus, so
    # these are shuffle joins at every size.
    def met(table, carried, differ):
        a, b = (_keyed(table, k, carried, x) for k, x in zip(ways, "ab"))
        return a.join(b.hint("merge"), "key").where(
            (F.col("a_last") <= F.col("b_last")) & differ).drop("key", "a_last", "b_last")

    short = words.where((size >= _Q * (_EDITS + 1)) & (size <= long_word + 1))
    found = met(short, ("word", "n"), (far == _EDITS))
    numbered = save(words.where(size >= long_word).select(
        F.monotonically_increasing_id().alias("id"), "word", "n"), "long-words")
    pairs = met(numbered, ("id",), F.col("a_id") != F.col("b_id")).distinct()
    for x in "ab":
        pairs = pairs.join(numbered.select(*(F.col(c).alias(f"{x}_{c}") for c in numbered.columns))
                           .hint("merge"), f"{x}_id").drop(f"{x}_id")
    found = found.unionByName(pairs.where(far == _EDITS))
    both = F.explode(F.array(*(F.struct(
        F.col(f"{x}_word").alias("a"), F.col(f"{x}_n").alias("a_n"),
        F.col(f"{y}_word").alias("b"), F.col(f"{y}_n").alias("b_n")) for x, y in ("ab", "ba"))))
    return found.select(both.alias("r")).select("r.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)`` rows: the last word along forms."""
    now = save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = save(now.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        now = new.select("word", "root")


def variants(words: DataFrame, *, ratio: int = 2) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words`` (``word``, ``n``)."""
    words = save(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("b_n")).alias("rank"), F.col("b").alias("word")))
    near = near_pairs(words).groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(near, "word", "left")
    wins = -F.col("best.rank") >= ratio * F.col("n")
    rows = save(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                            F.when(wins, F.col("best.word")).alias("form"),
                            F.when(wins, -F.col("best.rank")).alias("form_n")), "forms")
    ways = roots(rows.where("form IS NOT NULL"))
    return rows.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
