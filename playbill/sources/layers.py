"""Parquet layers with Hive-style partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.schemas import Table
from playbill.session import sized_for


def read_layer(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Read a layer table under its declared schema.

    The schema keeps partition columns as declared. Left to infer, Spark would
    read ``start_decade`` as int whenever no directory says ``unknown``.
    """
    return spark.read.schema(table.ddl).parquet(f"{root}/{table.name}")


def register_views(spark: SparkSession, root: str, tables: Iterable[Table]) -> None:
    """Make layer tables available to ``spark.sql`` under their own names."""
    for table in tables:
        read_layer(spark, root, table).createOrReplaceTempView(table.name)


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write Snappy Parquet, optionally in Hive-style partitions.

    Each partition value is gathered before the write, so that small values get
    one file. Unlike a plain ``repartition`` on those columns, the
    rebalance hint lets adaptive execution split a value that is too large for
    one task (one category may hold a third of all credits) into many files. What a task
    sorts is bounded, whatever the number of rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with sized_for(df):
        writer.parquet(path)


def partition_files(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Files, bytes and rows per partition value of a file-backed table.

    Counts per file first, so the second step sees one row per file.
    """
    per_file = df.groupBy(
        *partition_by, F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("rows"))
    return per_file.groupBy(*partition_by).agg(
        F.count("*").alias("file_count"), F.sum("size").alias("byte_count"),
        F.sum("rows").alias("row_count")
    )
