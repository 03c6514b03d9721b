"""A reproducible shuffle into shards: a keyed permutation of the global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill import workspace

ROUNDS = 6
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def half_bits(n: int) -> int:
    """Bits of each half of the smallest even-width domain that holds ``n`` numbers."""
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def _round_keys(seed: int) -> list[int]:
    return [(seed * _MIX[0] + (i + 1) * _STEP) % 2**64 for i in range(ROUNDS)]


def _network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    """One pass of the network over numbers of ``2 * bits`` bits; a bijection of them."""
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    with np.errstate(over="ignore"):
        for key in keys:
            f = (right + np.uint64(key)) * np.uint64(_MIX[0])
            f = (f ^ (f >> np.uint64(31))) * np.uint64(_MIX[1])
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
    return (left << shift) | right


def permuted(numbers: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Where each of ``numbers`` (all in 0 … n-1) stands in the shuffled order.

    The network permutes a power of four of at least ``n`` numbers. One that lands past
    ``n`` walks on along its cycle, which returns to a number below ``n`` at the latest
    at its own start, so this permutes 0 … n-1 too. A walk takes four steps at most on average.
    """
    bits, keys = half_bits(n), _round_keys(seed)
    at = _network(np.asarray(numbers).astype(np.uint64), bits, keys)
    out = np.flatnonzero(at >= n)
    while len(out):
        at[out] = _network(at[out], bits, keys)
        out = out[at[out] >= n]
    return at.astype(np.int64)


def place(number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of one global row number, without looking at any row."""
    at = int(permuted(np.array([number]), n, seed)[0])
    return at % shards, at // shards


def numbered(rows: DataFrame, *order: str, name: str = "row_number") -> DataFrame:
    """``rows`` with a gapless number from 0 in the order of the columns ``order``.

    Equal rows get neighbouring numbers, which of them which does not matter. Ranges of the order
    are sorted in parallel and stored in the shared folder; a number is the size of all
    earlier ranges plus the place in its own. A salt after the order lets a range end
    within rows that are equal in it, so no value, however common, fills one task. The
    driver sees one count per range.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{workspace(spark)}/numbered"
    columns = rows.columns
    (rows.withColumn("_salt", F.monotonically_increasing_id())
     .repartitionByRange(ranges, *order, "_salt")
     .sortWithinPartitions(*order, "_salt")
     .withColumn("_place", F.monotonically_increasing_id())
     .select(*columns, F.shiftright("_place", 33).alias("_range"),
             F.col("_place").bitwiseAND((1 << 33) - 1).alias("_within"))
     .write.parquet(path))
    stored = spark.read.parquet(path)
    before, offsets = 0, []
    for number, count in sorted(stored.groupBy("_range").count().collect()):
        offsets.append((number, before))
        before += count
    starts = spark.createDataFrame(offsets, "_range bigint, _before bigint")
    return (stored.join(F.broadcast(starts), "_range")
            .select(*columns, (F.col("_before") + F.col("_within")).alias(name)))


def shard(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """The shard and slot of every document under a keyed shuffle of all of them.

    One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 16),
    text_crc32, row_number (global, by doc_id, then size and checksum), shard, slot.
    Shards differ by one row at most and slots have no gaps. The result depends on the rows, ``shards`` and
    ``seed`` alone, not on files or partitions. A null text counts as empty, a null doc_id comes
    first; other columns are not read. Only these narrow rows are sorted, never texts.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = numbered(
        docs.select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
                    F.crc32(text).alias("text_crc32")),
        "doc_id", "size", "text_crc32")
    n = rows.count()

    @F.pandas_udf("bigint")
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), n, seed))

    at = F.col("_position")
    return (rows.withColumn("_position", position("row_number"))
            .select("doc_id", "size", "text_crc32", "row_number",
                    (at % shards).cast("int").alias("shard"),
                    F.expr(f"_position div {shards}").alias("slot")))
