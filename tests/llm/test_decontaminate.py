import collections
import random
import re

from tests.llm.conftest import rows, words
from tidemark.llm import decontaminate


def split(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def shingles(w, k):
    return collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, least=0.8):
    out = {}
    for d, t in docs:
        w = split(t)
        for i, it in items:
            v = split(it)
            if not v:
                continue
            k = min(5, len(v))
            a, best = shingles(v, k), 0
            for s in range(max(1, len(w) - len(v) + 1)):
                b = shingles(w[s:s + len(v)], k)
                m = sum((a & b).values())
                if m:
                    best = max(best, m / (sum(a.values()) + sum(b.values()) - m))
            if best >= least:
                out[d, i] = round(best, 9)
    return out


def test_planted_passages(spark, frame):
    rng = random.Random(5)
    items = [(k, " ".join(words(rng, n))) for k, n in enumerate((60, 40, 14, 5, 3, 1, 25))]
    items += [(7, None), (8, ""), (9, "Go " * 30)]
    docs = []
    for d in range(80):
        w = words(rng, rng.randint(0, 80))
        if d % 2:
            v = split(items[rng.randrange(7)][1])
            for _ in range(rng.choice((0, 0, 1, 3))):
                v[rng.randrange(len(v))] = "zzz"
            w[len(w) // 2:len(w) // 2] = v
        docs.append((d, ", ".join(w).title()))
    docs += [(100, None), (101, ""), (102, items[0][1][:250]), (103, "go " * 400)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame(docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got} == brute(
        docs, items)
    for r in got:
        assert 0 <= r["bits"] <= 23


def test_odd_rows_empty_tables_clashes(spark, odd, clashing, empty):
    bench = spark.createDataFrame([(1, "same " * 20), (1, "same " * 20)],
                                  "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    got = rows(decontaminate.contaminated(odd, bench))
    assert [r[:3] for r in got] == [(13, 1, 1.0)]
    assert rows(decontaminate.contaminated(clashing, bench)) == got
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(odd, none).count() == 0


def test_blocks_miss_no_pair_within_the_radius(spark):
    rng = random.Random(3)

    def far(f, n):
        for b in rng.sample(range(64), n):
            f ^= 1 << b
        return f - (1 << 64) if f >> 63 else f

    items = [(k, rng.getrandbits(63)) for k in range(4)]
    wins = [(n % 4, n, far(items[n % 4][1], n)) for n in range(40)]
    i = spark.createDataFrame(items, "item_id long, item_fp long")
    w = spark.createDataFrame(wins, "item_id long, content long, fp long")
    got = {(r["content"], r["item_id"]) for r in decontaminate.block_join(w, i, 23).collect()}
    assert got == {(n, n % 4) for n in range(24)}


def test_near_threshold_passages_and_candidates(spark, frame, monkeypatch):
    """Passages just over the threshold are all found, and no window meets an item that
    it shares nothing with: pairs grow with the passages, not with windows times items."""
    rng = random.Random(9)
    items = [(k, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60))) for k in range(60)]
    docs = []
    for d in range(400):
        w = [f"x{rng.randrange(10 ** 6)}" for _ in range(40)]
        v = split(items[d % 60][1])
        v[rng.randrange(6, 54)] = "zzz"  # five of 56 shingles go: similarity 51 / 61
        if d % 3 == 0:
            v[0] = "yyy"  # one more: 50 / 62
        w[20:20] = v
        docs.append((d, " ".join(w)))
    seen = []
    real = decontaminate.block_join
    monkeypatch.setattr(decontaminate, "block_join", lambda w, i, r: seen.append(
        (w.count(), i.count())) or real(w, i, r))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in
           decontaminate.contaminated(frame(docs), bench).collect()}
    expected = set(brute(docs, items))
    assert len(expected) == 400 and len(got & expected) >= 0.99 * len(expected)
    assert got <= expected
    (windows, n_items), = seen  # a window's row names its item: one pair of sixty at most
    assert n_items == 60 and windows <= 15 * len(docs)


def test_marks_drop_shingles_that_no_item_has(spark):
    own = spark.range(1000).selectExpr("xxhash64(id) AS s")
    marks, longs = decontaminate._marked(own)
    from pyspark.sql import functions as F
    hit = F.getbit(F.get(marks, decontaminate._long(F.col("s"), longs)),
                   F.col("s").bitwiseAND(F.lit(63)).cast("int")) == 1
    assert own.where(hit).count() == 1000
    assert spark.range(10 ** 6, 10 ** 6 + 20_000).selectExpr("xxhash64(id) AS s").where(
        hit).count() < 2500
