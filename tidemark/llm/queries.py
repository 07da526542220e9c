"""The registered queries: thin digests of the operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    cotrain,
    decontaminate,
    html_extract,
    langid,
    packing,
    quality_rules,
    search,
    secrets,
    simhash,
    spelling,
    substring_dedup,
    token_files,
    tokens,
    toxicity,
)
from tidemark.llm.common import documents
from tidemark.llm.sql import SQL  # noqa: F401


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    part = langid.remainder(F.col("doc_id"), 4)
    model = langid.train(docs, part != 2)
    held_out = F.coalesce(part == 2, F.lit(False)).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(documents(spark, sf_dir), tokens.default_path("byte_bpe_50k.json"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests).select("doc_id", "piece", "start", "length", "ids_crc32",
                                        "sequence_id", "offset")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(documents(spark, sf_dir),
                                 tokens.default_path("word_bpe_49k.json"))
    return token_files.read(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.assess(docs, quality_rules.train(docs, labels))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    part = langid.remainder(F.col("doc_id"), 3)
    model = toxicity.train(docs, labels, part != 1)
    held_out = F.coalesce(part == 1, F.lit(False)).alias("held_out")
    return toxicity.score(docs, model).select(
        "doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_quality_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cotrain.score(docs, cotrain.train(docs, labels))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return secrets.scan(documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_extract.extract(pages, html_extract.train(pages)).withColumn(
        "n_chars", F.length("text").cast("long"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.corpus_words(documents(spark, sf_dir), change=spelling.dropped_letter)
    return spelling.variants(words)


QUERIES = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "op4_pattern_packing": op4_pattern_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_files": op6_token_files,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_quality_cotrain": op9_quality_cotrain,
    "op10_secret_scan": op10_secret_scan,
    "op11_main_text": op11_main_text,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}
