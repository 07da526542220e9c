"""Secret scan, native DataFrame functions only.

Base kinds, each leftmost and without overlap: ``assign`` (a name, ``:`` or
``=``, and a value of at least 8 characters), ``access`` (an access key of at
least 16) and ``hex`` (at least 32 hexadecimal digits).

The method adds ``entropy`` spans: candidate strings are runs of at least
``window`` characters of the base-64 alphabet. Over each candidate a window of
``window`` characters slides; its Shannon entropy is kept up to date from the
counts of the character that leaves and the one that enters:
``H = log2(w) - sum(c log2 c) / w``. A candidate is reported if its greatest
window entropy reaches the limit of its character class, if no base span covers
it and if no entry of the allow-list matches it. Classes are tried in order: numbers
and words in one case are none of interest, letters in both cases without a digit need
most (:data:`CLASSES`). The work is linear in a candidate's length.

Positions count code points from 0, the end is exclusive. Regular-expression
functions return matches without places, so a pattern is matched together with
the gap before it and places are running sums of lengths.

Defined cases: a null text is empty and has no span; repeated rows are returned
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base kinds.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
_BLOCK = 100
#: Least window entropy in bits by class: (pattern of the whole string, bits); the first
#: that matches counts, None is never reported.
CLASSES = (
    (r"^[0-9+/_-]+={0,2}$", None),
    (r"^[a-z+/_-]+={0,2}$", None),
    (r"^[A-Z+/_-]+={0,2}$", None),
    (r"^[A-Za-z]+={0,2}$", 4.0),
    (r"^[A-Za-z+/_-]+={0,2}$", 4.2),
    (r"^[0-9a-fA-F]+$", 3.0),
    (r"^[A-Za-z0-9]+$", 3.7),
    (r"^[A-Za-z0-9+/_-]+={0,2}$", 3.8),
)
#: Strings that look random but are known not to be secrets.
ALLOW = (
    r"(?i)example|sample|placeholder|changeme|dummy|x{6,}",
    r"(?i)0123456789|abcdefghij|abcdef0123",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(1|256|384|512)-",
    r"^(\d{1,4}[-_/])+\d{1,4}$",
)


def _matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Array of ``(start, end, value)`` of all matches of ``pattern``."""
    # A last match of the empty string at the end takes the rest of the text at once.
    full = rf"(?s)(.*?)(?:({pattern})|\z)"

    def part(g):
        return F.regexp_extract_all(text, F.lit(full), F.lit(g))

    zipped = F.arrays_zip(part(1).alias("gap"), part(2).alias("hit"),
                          part(2 + value_group).alias("value"))

    def place(pos, x):
        start = pos + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return end, F.when(x["hit"] != "", F.array(F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value"))))

    return _scan(zipped, "struct<start:int,end:int,value:string>", place)


def _uncovered(spans: Column, covers: Column) -> Column:
    """The ``spans`` that none of ``covers`` covers, in order."""
    def marked(xs, cover):
        return F.transform(xs, lambda x: F.struct(
            x["start"].alias("start"), F.lit(cover).alias("mine"), x["end"].alias("end"),
            x["value"].alias("value")))

    both = F.array_sort(F.concat(marked(covers, False), marked(spans, True)))

    def keep(far, x):  # `far`: the greatest end of what covers up to here
        out = F.when(x["mine"] & (x["end"] > far), F.array(F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))))
        return F.when(x["mine"], far).otherwise(F.greatest(far, x["end"])), out

    return _scan(both, "struct<start:int,end:int,value:string>", keep)


def _scan(items: Column, kind: str, step) -> Column:
    """Array of what ``step(state, item)`` puts out (an array or NULL) beside the next state, an
    integer from 0. Results of a block are added at once, as each addition copies all."""
    none = F.array().cast(f"array<{kind}>")

    def one(acc, x):
        state, out = step(acc["state"], x)
        return F.struct(state.alias("state"),
                        F.concat(acc["out"], F.coalesce(out, none)).alias("out"))

    def many(acc, part):
        block = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return _let(block, lambda b: F.struct(
            b["state"].alias("state"), F.concat(acc["out"], b["out"]).alias("out")))

    blocks = _let(items, lambda z: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(z), F.lit(1)), F.lit(_BLOCK)),
        lambda k: F.slice(z, k, _BLOCK)))
    return F.aggregate(blocks, F.struct(F.lit(0).alias("state"), none.alias("out")), many)["out"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, as lambdas share no subexpressions."""
    return F.transform(F.array(value), body)[0]


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """Greatest Shannon entropy (bits) of any ``window`` characters of ``text``, which has
    at least so many, of one byte each. Places are found from the start of a string, so
    ``text`` is cut into short blocks first; a block goes on into the next by a window."""
    blocks = _let(F.regexp_extract_all(text, F.lit(f"(.{{1,{_BLOCK}}})"), F.lit(1)),
                  lambda p: F.transform(p, lambda x, k: F.concat(
                      x, F.coalesce(F.substring(F.get(p, k + 1), 1, window - 1), F.lit("")))))
    return F.array_max(F.transform(blocks, lambda x: _block_entropy(x, window)))


def _block_entropy(text: Column, window: int) -> Column:
    # What c * log2(c) grows by when a character comes to c others of its kind.
    grows = F.array(*(F.lit((c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0.0))
                      for c in range(window + 1)))

    def without(s, ch):
        return F.length(F.replace(s, ch, F.lit("")))

    def step(acc, i):
        held = F.substring(text, F.greatest(i - window, F.lit(0)) + 1, F.least(i, F.lit(window)))
        full = i >= window

        def move(h):
            left = F.when(full, F.get(grows, window - 1 - without(h, F.substring(h, 1, 1))))
            rest = F.when(full, F.substring(h, 2, window - 1)).otherwise(h)
            came = F.get(grows, F.least(i, F.lit(window - 1)) - without(
                rest, F.substring(text, i + 1, 1)))
            return _let(acc["s"] + came - F.coalesce(left, F.lit(0.0)), lambda s: F.struct(
                s.alias("s"), F.when(i >= window - 1, F.least(acc["least"], s))
                .otherwise(acc["least"]).alias("least")))

        return _let(held, move)

    zero = F.struct(F.lit(0.0).alias("s"), F.lit(float("inf")).alias("least"))
    least = F.aggregate(F.sequence(F.lit(0), F.length(text) - 1), zero, step)["least"]
    return F.lit(math.log2(window)) - least / window


def _suspicious(value: Column, window: int) -> Column:
    """Does the candidate pass the allow-list and reach its class's entropy?"""
    limit = F.lit(None).cast("double")
    for pattern, bits in reversed(CLASSES):
        limit = F.when(value.rlike(pattern), F.lit(bits).cast("double")).otherwise(limit)
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | value.rlike(pattern)
    return F.when(limit.isNotNull() & ~allowed,
                  window_entropy(value, window) >= limit - 1e-9).otherwise(False)


def scan(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(row, text, spans)`` for every row of ``docs``: the row as a struct, its
    text (null is empty) and an array of ``(start, rank, end, kind)`` in order of
    start, then kind."""
    rows = docs.select(F.struct("*").alias("row"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    candidate = rf"[A-Za-z0-9+/_-]{{{window},}}={{0,2}}"
    # One look at each text; only texts with something to look at go on.
    t = F.col("text")
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def where(test, matches):
        return F.when(test, matches).otherwise(none)

    found = rows.select(
        "row", "text",
        where(t.rlike(ASSIGN), F.filter(_matches(t, ASSIGN, 2),
                                        lambda m: F.length(m["value"]) >= 8)).alias("assign"),
        where(t.contains("AKIA"), _matches(t, ACCESS)).alias("access"),
        where(t.rlike(HEX), _matches(t, HEX)).alias("hex"),
        where(t.rlike(rf"[A-Za-z0-9+/_-]{{{window},}}"), _matches(t, candidate)).alias("entropy"))

    def ranked(name):
        k = KINDS.index(name)
        return F.transform(name, lambda m: F.struct(
            m["start"].alias("start"), F.lit(k).alias("rank"), m["end"].alias("end"),
            F.lit(name).alias("kind")))

    base = F.flatten(F.array(*KINDS[:3]))
    # A covered candidate is not looked at further.
    free = F.filter(_uncovered(F.col("entropy"), base), lambda e: _suspicious(e["value"], window))
    found = found.withColumn("entropy", F.when(F.size("entropy") > 0, free).otherwise(none))
    return found.select("row", "text", F.array_sort(F.concat(*map(ranked, KINDS))).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, overlapping ones as one, replaced by ``mark``."""
    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc, s):
        new = s["start"] >= acc["pos"]
        before = F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.when(new, F.concat(acc["out"], before, F.lit(mark)))
                        .otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, zero, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
