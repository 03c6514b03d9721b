"""From raw documents to token ids: five stages, each over all that the one before kept.

Documents without a determined language go, then exact copies, near copies and benchmark
passages; what stays is encoded. Each stage is stored and read again by the next, so a lost
executor costs a re-read of Parquet.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playbill import workspace
from playbill.llm import bpe, decontaminate, exact, jaccard, language
from playbill.llm.queries import language_model, table

#: share of the letters that a document's language has at least
LEAST_SHARE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, whose language has LEAST_SHARE of them; mixed texts mostly stay."""
    return language.keep_known(docs, language_model(docs), LEAST_SHARE)


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest of documents that are the same without white space."""
    return exact.keep_one(docs, workspace(spark))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of documents linked by a similarity of 0.8 in runs of five words."""
    return jaccard.keep_one(docs, workspace(spark))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), workspace(spark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of each text, and the digest of the bytes decoded from them."""
    return bpe.round_trip(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("exact_dedup", one_of_copies),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("byte_bpe", encoded),
]

ORACLE_SQL = None  # SQL can neither learn a language nor encode


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    root = workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
