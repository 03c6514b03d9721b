"""One query per operator, over its whole tables: (spark, folder) -> frame."""

from __future__ import annotations

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill import workspace
from playbill.llm import (
    bpe, decontaminate, exact, jaccard, language, periodic, quality, repeats, shards, token_files,
    topk, toxicity, whitening,
)


ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did.

    Enough where the repository lies at one path everywhere, as in local mode; elsewhere
    it is shipped with --py-files, and this adds a path that does not exist.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, ROOT]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(
        table(spark, sf_dir, "documents"), workspace(spark), jaccard.Similarity(4, 85)
    ).select("doc_id", F.col("size").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{workspace(spark)}/tokens"
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path,
        public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_files(spark, path, ids=False)


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), workspace(spark)).drop("spans")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.findings(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), workspace(spark)
    ).select("doc_id", "n_words", "n_hit", "n_items",
             F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def language_model(docs: DataFrame) -> language.Model:
    """Learned from all rows that are not held out."""
    return language.learn(docs.where(language.remainder(4) != 2))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language_model(docs)).select(
        "doc_id", (language.remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(language.remainder(4) != 2)
    return toxicity.predict(docs, toxicity.fit(docs, labels, workspace(spark))).select(
        "doc_id", (language.remainder(4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(language.remainder(3) != 1)
    return quality.predict(docs, quality.fit(docs, labels)).select(
        "doc_id", (language.remainder(3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(table(spark, sf_dir, "documents"), workspace(spark)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), workspace(spark))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, "embedding", whitening.fit(rows, "embedding"), ("vec_id",))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; the words of every tenth text, by checksum of its doc_id, become periodic
    from a word that follows from the checksum too, and are joined by one space."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(
        F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    numbers = docs.select("doc_id", "text", checksum.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)).select(
        "*", F.size("words").cast("bigint").alias("n"), F.floor(F.col("h") / 10).alias("g"))
    numbers = numbers.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    numbers = numbers.withColumn("rest", (F.col("n") - F.col("a")).cast("int")).withColumn(
        "p", (1 + F.floor(F.col("rest") / (3 + F.col("g") % 8))).cast("int"))
    tail = F.slice(
        F.flatten(F.array_repeat(
            F.slice("words", F.col("a") + 1, F.col("p")),
            F.ceil(F.col("rest") / F.col("p")).cast("int"))),
        1, F.col("rest"))
    changed = F.array_join(F.concat(F.slice("words", 1, F.col("a")), tail), " ")
    return numbers.select(
        "doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.detect(with_periodic_tails(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shortness"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("longest.start").alias("start"),
        (-F.col("longest.shortness")).alias("length"), F.col("longest.period").alias("period"),
        F.floor(-1000 * F.col("longest.shortness") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {
    f.__name__: f for f in (
        op1_ngram_jaccard,
        op2_byte_bpe,
        op3_token_files,
        op4_feistel_shards,
        op5_suffix_repeats,
        op6_decontamination,
        op7_language,
        op8_toxicity,
        op9_quality,
        op10_exact_dedup,
        op11_exact_top_k,
        op12_whitening,
        op13_periodic_runs,
    )
}
