import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
#: Columns named like the operators' own.
CLASHES = ("h", "fp", "task", "start", "spans", "row", "w", "at", "label", "a", "b", "size")


def words(rng, n, syllables=("ba", "ko", "ri", "tu", "men", "sal")):
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    rng = random.Random(1)
    base = words(rng, 60)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "..."), (5, "ok"), (6, "two words"),
            (7, " ".join(base)), (8, " ".join(base)), (8, " ".join(base)),
            (9, " ".join(words(rng, 5) + base[10:40] + words(rng, 5))),
            (10, " ".join(words(rng, 40_000))), (11, "é ß \U0001f600 x" * 20),
            (None, " ".join(base[:30])), (None, None), (12, "A" * 50_000),
            (13, "same " * 500), (14, " ".join(base).upper())]
    return [(i, t, "xx" if i and i % 2 else None, None if i == 7 else "s", len(t) if t else None)
            for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F
    return odd.select("*", *(F.lit("clash").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, t, None, "s", len(t) if t else None) for i, t in rows], DOCS)
    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is None, str(x)) for x in r])
