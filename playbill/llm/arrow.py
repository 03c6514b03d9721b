"""Arrow batches as byte arrays: the shape in which numpy code reads texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of text handled at once by numpy code, which holds some arrays of eight times that
SLICE_BYTES = 1 << 19


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins and the last ends.

    A null counts as an empty text.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64 if wide else np.int32)
    begin = begin[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[begin[0]:begin[-1]], begin - begin[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about ``limit`` bytes of text; a longer text comes alone."""
    for batch in batches:
        _, begin = text_bytes(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(begin, begin[row] + limit, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


FAN_IN = 1024


def summed(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of packed counters by ``keys``: rows (part int, *keys, counts binary of int64).

    ``part`` numbers the tasks that made the rows. They are added up in two levels, so no
    task holds more than FAN_IN of them at once, of up to FAN_IN squared tasks.
    """
    fields = ", ".join(
        ["part int", *(f"`{k}` {parts.schema[k].dataType.simpleString()}" for k in keys),
         "counts binary"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in table.column("counts"))
        row = table.slice(0, 1)
        return pa.table([*(row.column(c) for c in ("part", *keys)), pa.array([total.tobytes()])],
                        ["part", *keys, "counts"])

    for _ in range(2):
        parts = parts.select((F.col("part") / FAN_IN).cast("int").alias("part"), *keys, "counts")
        parts = parts.groupBy("part", *keys).applyInArrow(add, fields)
    return parts


def fixed_filter(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A filter of 2 ** ``bits`` bits that lets all 64-bit ``column`` of ``values`` pass, and by
    chance some others. Its size, 2 ** bits / 8 bytes, does not depend on the data."""
    bit = F.pmod(column, F.lit(1 << bits)) + 1
    blocks = (
        values.groupBy(F.bitmap_bucket_number(bit).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect())
    wanted = np.zeros(max(1 << bits, 32768), bool)
    for row in blocks:  # 2 ** bits / 32768 of them
        found = np.unpackbits(np.frombuffer(bytes(row.bits), np.uint8), bitorder="little")
        wanted[(row.block - 1) * 32768:row.block * 32768] = found
    return np.packbits(wanted)


def passing(packed: np.ndarray, bits: int, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``values`` the filter lets pass."""
    place = values.astype(np.int64) & ((1 << bits) - 1)
    return (packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
