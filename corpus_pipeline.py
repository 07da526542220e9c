"""The corpus pipeline: stages over ``documents``, each written and read again.

Language ID, SimHash near-duplicates, benchmark decontamination, secret scan,
packing. All stages but the last return the columns of ``documents``. Rows
without a doc_id cannot be named by a decision that goes by doc_id: the
near-duplicate and decontamination stages keep them. A null text is rejected by
the language stage; empty tables pass through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, packing, secrets, simhash, tokens
from tidemark.llm.common import discard, documents, save

#: A text's language is uncertain below this probability; the document goes.
MIN_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a recognised language stay (all, if there is no
    labelled document to learn from)."""
    model = langid.train(docs, langid.remainder(F.col("doc_id"), 4) != 2)
    if model is None:
        return docs
    told = langid.annotate(docs, model, "_lang_pred", "_lang_score")
    sure = (F.col("_lang_pred") != "und") & (F.col("_lang_score") >= MIN_LANGUAGE_SCORE)
    return told.where(sure).drop("_lang_pred", "_lang_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the least doc_id;
    equal rows count as one."""
    groups = save(simhash.near_duplicates(docs), "groups")
    stay = groups.where("doc_id = component_id").groupBy("doc_id").count()
    stay = save(stay, "stay")
    # The ids grow with the corpus, so they are joined by a shuffle at every size.
    ids = stay.select("doc_id").hint("merge")
    kept = docs.join(ids, "doc_id", "left_semi").select(docs.columns)
    if not stay.where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id IS NULL"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window similar to a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = save(decontaminate.contaminated(docs, benchmark).select("doc_id").distinct(),
                 "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; found secrets are replaced in its text."""
    found = secrets.scan(docs)
    any_ = F.size("spans") > 0
    text = secrets.redacted(F.col("text"), F.col("spans"))
    new = {"text": F.when(any_, F.col("_text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(any_, F.length("_text")).otherwise(F.col("row.n_chars"))
    return found.select("row", "spans", text.alias("_text")).select(
        *(new[c].cast(docs.schema[c].dataType).alias(c) if c in new
          else F.col("row")[c].alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens."""
    pieces = packing.pieces(docs, tokens.default_path("byte_bpe_50k.json"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests).select("doc_id", "piece", "start", "length", "ids_crc32",
                                        "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secret_scan", secrets_redacted),
    ("packing", packed),
]

#: Networks and tokenizers cannot be expressed in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
        if before is not None:  # what the next stage has read and written anew
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
