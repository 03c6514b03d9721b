"""Exact deduplication as a stateful stream, by DataFrame functions alone.

Texts are equal when they are the same after white space is removed. Each document
arrives as its digest and its locator, the file and row that hold the whole text. The
stream's state, in RocksDB on the executors' disks with changelogs in the checkpoint, has one
entry per digest that never expires: how many documents had it, and the identifier and
locator of the one that stays. Wherever a digest was hit again, the full texts are
fetched by locator and compared byte by byte, so the result does not hang on the digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: how the stream keeps its state: on disk, as changelogs in the checkpoint, and closed by
#: each task that has written its part, so that executors do not hold all parts open
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}

#: what equality ignores: space, and the five control characters that move the print position
IGNORED = " \t\n\v\f\r"


def normalised(text: Column) -> Column:
    """The text without white space; a null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for character in IGNORED:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame) -> DataFrame:
    """doc_id, text and the locator (file, row) of each row of a frame read from files."""
    metadata = docs.metadataColumn("_metadata")
    return docs.select(
        "doc_id", "text", metadata["file_path"].alias("file"), metadata["row_index"].alias("row"))


def arrive(docs: DataFrame, path: str, digest: Callable[[Column], Column] = sha256) -> None:
    """Append the documents to the stream's folder, without their texts."""
    (located(docs)
     .select("doc_id", digest(normalised(F.col("text"))).alias("digest"),
             F.length(F.coalesce("text", F.lit(""))).alias("length"), "file", "row")
     .write.mode("append").parquet(path))


def first_of_each(arrivals: DataFrame, *also_by: str) -> DataFrame:
    """Digest, number of documents, and the one that stays.

    The longest text stays, then the smallest doc_id (a null one last), then the
    first by locator, so that of rows alike in everything exactly one stays.
    """
    return arrivals.groupBy("digest", *also_by).agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(
            (-F.col("length")).alias("shortness"), F.col("doc_id").isNull().alias("unnamed"),
            "doc_id", "file", "row")).alias("keep"))


def drain(spark: SparkSession, arrivals: str, checkpoint: str) -> None:
    """Run the stream over whatever has arrived since it last ran, then stop it.

    The checkpoint holds progress and state, so a stream that broke off goes on where it was.
    The state has as many partitions as shuffles had when it was first run.
    """
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    try:
        for key, value in STATE_CONF.items():
            spark.conf.set(key, value)
        schema = spark.read.parquet(arrivals).schema
        query = (
            first_of_each(spark.readStream.schema(schema).parquet(arrivals))
            .writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stream's state: digest, group_size and the columns of the document that stays."""
    stored = spark.read.format("statestore").load(checkpoint)
    size, keep = stored.schema["value"].dataType.names
    return stored.select(
        "key.digest", F.col(f"value.`{size}`").alias("group_size"),
        F.col(f"value.`{keep}`.doc_id").alias("keep_id"),
        F.col(f"value.`{keep}`.file").alias("keep_file"),
        F.col(f"value.`{keep}`.row").alias("keep_row"))


def verified(docs: DataFrame, groups: DataFrame, arrivals: DataFrame, path: str) -> DataFrame:
    """Arrivals that were hits, and whether their full text is that of the one that stays.

    Texts are fetched by locator, which is unique, so no key is hot; those of documents whose
    digest came once are dropped in that join. The comparison joins by digest, where
    the side that stays has one row per digest and the other may be split.
    """
    hits = arrivals.join(groups.where("group_size > 1"), "digest").select(
        "digest", "file", "row", "keep_file", "keep_row")
    texts = located(docs).select("file", "row", normalised(F.col("text")).alias("content"))
    hits.join(texts, ["file", "row"]).write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    staying = stored.where("file = keep_file and row = keep_row").select(
        "digest", F.col("content").alias("kept_content"))
    return stored.join(staying, "digest").withColumn(
        "same", F.col("content") == F.col("kept_content"))


def deduplicate(
    docs: DataFrame, work: str, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``docs``, a frame read from files: doc_id, digest, file, row,
    keep_id, group_size, kept.

    Exactly one row of each group of equal texts is kept. Empty and null texts are equal
    to each other. Other columns of ``docs`` are not read. ``work`` is an unused folder that
    all executors share. If texts that differ should share a digest, which a
    weaker ``digest`` allows, those digests are grouped again by their full texts.
    """
    spark = docs.sparkSession
    arrive(docs, f"{work}/arrivals", digest)
    drain(spark, f"{work}/arrivals", f"{work}/checkpoint")
    arrivals = spark.read.parquet(f"{work}/arrivals")
    state(spark, f"{work}/checkpoint").write.parquet(f"{work}/groups")
    groups = spark.read.parquet(f"{work}/groups")
    compared = verified(docs, groups, arrivals, f"{work}/hits")
    # distinct only once stored, so that the join above it may split a hot digest
    compared.where("not same").select("digest").write.parquet(f"{work}/collided")
    collided = spark.read.parquet(f"{work}/collided").distinct()
    if collided.isEmpty():
        return _decided(arrivals.join(groups, "digest"))
    contents = spark.read.parquet(f"{work}/hits").join(collided, "digest", "left_semi")
    apart = arrivals.join(contents.select("file", "row", "content"), ["file", "row"])
    parts = first_of_each(apart, "content").select(
        "digest", "content", "group_size", F.col("keep.doc_id").alias("keep_id"),
        F.col("keep.file").alias("keep_file"), F.col("keep.row").alias("keep_row"))
    return _decided(
        arrivals.join(collided, "digest", "left_anti").join(groups, "digest")
    ).unionByName(_decided(apart.join(parts, ["digest", "content"])))


def _decided(joined: DataFrame) -> DataFrame:
    return joined.select(
        "doc_id", "digest", "file", "row", "keep_id", "group_size",
        ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"))


def keep_one(docs: DataFrame, work: str) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    metadata = docs.metadataColumn("_metadata")
    kept = deduplicate(docs, work).where("kept").select(
        F.col("file").alias("_file"), F.col("row").alias("_row"))
    return docs.join(
        kept, (metadata["file_path"] == kept["_file"]) & (metadata["row_index"] == kept["_row"]),
        "left_semi")
