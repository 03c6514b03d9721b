"""Columns of vectors: which rows take part, and their components as integers in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is not null, not empty, and holds neither nulls nor non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have, of several the greatest; 0 without vectors."""
    lengths = rows.groupBy(F.size(vector).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    row = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return row.length if row else 0


def scaled(column: pa.Array, length: int, factor: int, offset: int = 0) -> np.ndarray:
    """floor(factor * c) + offset of each entry c as double: one row of integers per vector.

    Entries whose result would not fit 62 bits are refused.
    """
    values = np.asarray(column.flatten(), np.float64).reshape(-1, length)
    whole = np.floor(values * factor)
    if np.abs(whole).max(initial=0) >= 2.0 ** 62:
        raise ValueError("an entry is too large for a whole number of 64 bits")
    return whole.astype(np.int64) + offset
