"""Delimited text with a header and a NULL token."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.schemas import NULL_TOKEN
from playbill.session import sized_for


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str,
    null_token: str = NULL_TOKEN,
    sep: str = "\t",
    quote: str = "",
    strict_header: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read text files under a declared schema, never inferring types.

    Columns are bound by position; ``strict_header`` rejects files whose header
    disagrees. Short rows are padded with NULL, extra fields dropped and
    unreadable typed cells read as NULL; ``corrupt_column`` keeps the raw line
    of such rows (cells are checked only in the columns a query reads). Quoting is off by default because tab-separated dumps do not
    quote: with ``quote='"'`` a title that starts with a stray quote swallows
    the fields after it. Plain files split by ``spark.sql.files.maxPartitionBytes``;
    compressed ones do not, so unpack or split large archives before reading.
    """
    if corrupt_column:
        schema = f"{schema}, `{corrupt_column}` string"
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("nullValue", null_token)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not strict_header)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def write_delimited(
    df: DataFrame,
    path: str,
    null_token: str = NULL_TOKEN,
    sep: str = "\t",
    mode: str = "overwrite",
    compression: str = "none",
    max_rows: int = 0,
) -> None:
    """Write unquoted text with a header per file, as ``read_delimited`` reads it.

    Compressed files do not split, so give the most rows of one as ``max_rows`` (0: any number).
    """
    writer = (
        df.write.mode(mode)
        .option("compression", compression)
        .option("maxRecordsPerFile", max_rows)
        .option("header", True)
        .option("sep", sep)
        .option("quote", "")
        .option("nullValue", null_token)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    with sized_for(df):
        writer.csv(path)


def corrupt_count(
    spark: SparkSession, path: str, schema: str, columns: Sequence[str], **options
) -> DataFrame:
    """One row (row_count, corrupt_count): lines that are short, long or hold an unreadable cell.

    All of ``columns`` are read, since cells are checked only where they are."""
    rows = read_delimited(spark, path, schema, corrupt_column="_corrupt", **options)
    # always true, which the optimizer cannot know, so it has every cell read
    read = F.length(F.concat_ws("", *(F.col(c).cast("string") for c in columns))) >= 0
    return rows.agg(
        F.count("*").alias("row_count"),
        F.count_if(read & F.col("_corrupt").isNotNull()).alias("corrupt_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """Rows of (column_name, null_count), from one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")
