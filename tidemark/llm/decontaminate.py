"""Benchmark decontamination by SimHash windows, native DataFrame functions only.

Words are runs of letters and digits of the lower-cased text. For a benchmark
item of ``L`` words, a document's windows are all its runs of ``L`` words (a
shorter document is one window). Shingles are ``shingle`` words (an item of
fewer words is one shingle); a shingle's weight is how often it occurs.

1. Anchors: document positions whose shingle an item has. A window similar
   enough must hold so many anchors of the item that windows with fewer can be
   left out without loss; what is left has at most ``S - need + 1`` starts per
   anchor. So a document with no passage costs one hash join and no window.
2. Every window left gets a 64-bit SimHash of its weighted shingles, as does
   every item.
3. Multi-index Hamming blocks: fingerprints within ``radius`` (23) bits agree on
   one of eight 8-bit blocks up to ``radius // 8`` (2) bits, so items are listed
   under all block values that near and windows under their own: no pair within
   the radius is missed. At similarity 0.8 the distance is 10 bits on average with a
   deviation of 3, so the radius lies over four deviations off. Blocks of a radius that
   wide select little by themselves; the anchors' item is part of the key, so a window
   meets the items it shares shingles with and no others.
4. Candidates are verified by exact weighted similarity,
   sum of least weights / sum of greatest weights >= ``similarity``.

Equal windows of an item are compared once by content and dealt back to their documents, so
a passage in a third of all documents is compared once.

Defined cases: null or wordless texts and items match nothing; repeated rows
give one result row; a null ``doc_id`` is a result row of its own; empty tables
give an empty result; extra columns are ignored; ties go to the first window.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import save

_BLOCKS, _BITS = 8, 8


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingle_hashes(hashes: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` word hashes."""
    last = F.size(hashes) - size
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *(F.get(hashes, i + k) for k in range(size))))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<bigint>"))


def simhash(shingles: Column) -> Column:
    """Bit ``b`` is set if over half of the shingles have it set."""
    def bit(b):
        ones = F.aggregate(shingles, F.lit(0), lambda a, x: a + F.getbit(x, b).cast("int"))
        return F.when(2 * ones > F.size(shingles), F.lit(1)).otherwise(F.lit(0)).cast("long")

    # The 64 bits as a sum of powers of two, in two halves that cannot overflow.
    def half(lo):
        return F.aggregate(F.sequence(F.lit(lo), F.lit(lo + 31)), F.lit(0).cast("long"),
                           lambda a, b: a + bit(b) * F.pow(F.lit(2), b - lo).cast("long"))

    return F.shiftleft(half(32), 32).bitwiseOR(half(0))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of least over sum of greatest weights of two shingle lists."""
    def times(xs, s):
        return F.size(F.filter(xs, lambda x: x == s))

    least = F.aggregate(F.array_distinct(a), F.lit(0),
                        lambda acc, s: acc + F.least(times(a, s), times(b, s)))
    return least / (F.size(a) + F.size(b) - least)


def _block(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, k * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long"))


def block_join(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """``windows`` (``item_id``, ``content``, ``fp``) whose ``fp`` differs in at most ``radius``
    bits from the ``item_fp`` of the item that anchored them."""
    near = radius // _BLOCKS
    masks = [sum(1 << b for b in bits) for n in range(near + 1)
             for bits in combinations(range(_BITS), n)]

    def listed(df, fp, masks):
        keys = [F.struct(F.lit(k).alias("block"),
                         _block(F.col(fp), k).bitwiseXOR(F.lit(m).cast("long")).alias("value"))
                for k in range(_BLOCKS) for m in masks]
        return df.select("*", F.explode(F.array(*keys)).alias("_b")).select(
            *df.columns, "_b.block", "_b.value")

    keys = listed(windows.select("item_id", "content", "fp"), "fp", [0])
    probes = listed(items.select("item_id", "item_fp"), "item_fp", masks)
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    return (keys.join(probes, ["item_id", "block", "value"]).where(bits <= radius)
            .select("item_id", "content", bits.alias("bits")).distinct())


def _marked(shingles: DataFrame) -> tuple[Column, int]:
    """A bit for each hash of ``shingles`` (``s``) as an array of longs, and how many longs:
    16 bits a shingle, 8 MB at most."""
    n = shingles.count()
    longs = 1 << min(max(n, 64).bit_length(), 20) - 2
    bit = F.expr("shiftleft(1L, cast(s & 63 AS int))")
    words = shingles.groupBy(_long(F.col("s"), longs).alias("k")).agg(F.bit_or(bit).alias("w"))
    spark = shingles.sparkSession
    every = spark.range(longs).select(F.col("id").cast("int").alias("k")).join(words, "k", "left")
    row = F.array_sort(F.collect_list(F.struct("k", F.coalesce("w", F.lit(0).cast("long")).alias("w"))))
    return save(every.agg(row.alias("r")).select(F.transform("r", lambda x: x["w"]).alias("w")),
                "marks").scalar(), longs


def _long(s: Column, longs: int) -> Column:
    return F.shiftrightunsigned(s, 6).bitwiseAND(F.lit(longs - 1).cast("long")).cast("int")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, shingle: int = 5,
                 similarity: float = 0.8, radius: int = 23) -> DataFrame:
    """``(doc_id, item_id, similarity, bits, start, n_words)``: for each document and
    item, the most similar window if it reaches ``similarity``."""
    items = (benchmark.select(F.col("item_id"), words(F.col("text")).alias("w")).distinct()
             .where(F.size("w") > 0)
             .select("item_id", F.size("w").alias("size"),
                     F.least(F.lit(shingle), F.size("w")).alias("k"),
                     F.transform("w", lambda x: F.xxhash64(x)).alias("h")))
    by_k = F.coalesce(*(F.when(F.col("k") == k, shingle_hashes(F.col("h"), k))
                        for k in range(1, shingle + 1)))
    items = items.select("item_id", "size", "k", by_k.alias("item_shingles"))
    items = save(items.withColumn("item_fp", simhash(F.col("item_shingles"))), "items")
    sizes = sorted(r[0] for r in items.select("k").distinct().collect())  # at most `shingle`
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    hashed = rows.select("doc_id", F.xxhash64("text").alias("th"),
                         F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))

    # 1. Anchors, and from them the starts of windows that can be similar enough.
    starts = None
    for k in sizes:
        own = items.where(F.col("k") == k)
        probe = own.select(F.explode(F.array_distinct("item_shingles")).alias("s"), "item_id",
                           "size", F.size("item_shingles").alias("n"))
        marks, longs = _marked(probe.select("s").distinct())
        # The marks drop nearly all shingles before a join that may have to shuffle them.
        may = F.getbit(F.get(marks, _long(F.col("s"), longs)),
                       F.col("s").bitwiseAND(F.lit(63)).cast("int")) == 1
        at = (hashed.select("doc_id", "th", F.size("h").alias("len"),
                            F.posexplode(shingle_hashes(F.col("h"), k)).alias("p", "s"))
              .where(may).join(probe, "s"))
        per = (at.groupBy("doc_id", "th", "len", "item_id", "size", "n")
               .agg(F.sort_array(F.collect_set("p")).alias("p")))
        least = F.when(F.col("len") >= F.col("size"),
                       F.ceil(F.col("n") * (2 * similarity / (1 + similarity)) - 1e-9)
                       ).otherwise(F.ceil(F.col("n") * similarity - 1e-9)).cast("int")
        per = per.withColumn("need", F.greatest(least, F.lit(1))).where(
            F.size("p") >= F.col("need"))
        dense = F.filter("p", lambda x, i: F.get(F.col("p"), i + F.col("need") - 1)
                         <= x + F.col("n") - 1)
        begin = F.flatten(F.transform(dense, lambda x: F.sequence(
            F.greatest(x - (F.col("n") - F.col("need")), F.lit(0)), x)))
        begin = F.when(F.col("len") >= F.col("size"), F.filter(
            begin, lambda s: s + F.col("size") <= F.col("len"))).otherwise(F.array(F.lit(0)))
        part = per.select("doc_id", "th", F.lit(k).alias("k"), "item_id", "size",
                          F.explode(F.array_distinct(begin)).alias("start"))
        starts = part if starts is None else starts.unionByName(part)
    if starts is None:
        starts = hashed.limit(0).crossJoin(items.limit(0).select("item_id")).select(
            "doc_id", "th", F.lit(1).alias("k"), "item_id", F.lit(1).alias("size"),
            F.lit(0).alias("start"))
    listed = save(starts.groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("k", "item_id", "size", "start")).alias("at")), "starts")

    # 2. Fingerprints of the windows, once for each content.
    same = [F.col("d.doc_id").eqNullSafe(F.col("a.doc_id")), F.col("d.th") == F.col("a.th")]
    found = (hashed.alias("d").join(listed.alias("a"), same)
             .select("d.doc_id", "h", F.explode("at").alias("at"))
             .select("doc_id", "at.*", F.slice("h", F.col("at.start") + 1,
                                               F.col("at.size")).alias("h")))
    shingles = F.coalesce(*(F.when(F.col("k") == k, shingle_hashes(F.col("h"), k))
                            for k in sizes or [1]))
    found = found.select("doc_id", "item_id", "start", F.size("h").alias("n_words"),
                         shingles.alias("shingles"))
    found = save(found.withColumn("content", F.xxhash64("shingles")), "windows")
    contents = found.groupBy("item_id", "content").agg(F.first("shingles").alias("shingles"))
    contents = save(contents.withColumn("fp", simhash(F.col("shingles"))), "contents")

    # 3. and 4. Blocks find the candidates, the weighted shingles decide.
    pairs = block_join(contents, items, radius)
    checked = (pairs.join(contents.select("item_id", "content", "shingles"),
                          ["item_id", "content"])
               .join(items.select("item_id", "item_shingles"), "item_id")
               .withColumn("similarity",
                           weighted_similarity(F.col("shingles"), F.col("item_shingles")))
               .where(F.col("similarity") >= similarity)
               .select("item_id", "content", "bits", "similarity"))
    hits = found.select("doc_id", "item_id", "content", "start", "n_words").join(
        checked, ["item_id", "content"])
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words", "bits"))
    return (hits.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.similarity", "b.bits",
                    (-F.col("b.before")).alias("start"), "b.n_words"))
