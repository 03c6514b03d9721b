"""Whitening of embeddings through the leading eigenpairs of their covariance.

Sums and the covariance are added up over all vectors, each task sending one small matrix; the
eigenpairs come from spectrum slicing on the driver, whose input is that one matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.arrow import FAN_IN
from playbill.llm.spectrum import Slicer
from playbill.llm.vectors import finite, scaled, usual_length


@dataclass(frozen=True)
class Whitening:
    """n, sums and total variance of the fitted vectors; eigenvalues and unit vectors as rows."""

    length: int
    factor: int
    offset: int
    n: int
    sums: np.ndarray
    total: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        moved = x * self.n - self.sums
        most = int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0))
        if most >= 1 << 62:
            raise ArithmeticError("n times a component does not fit 64 bits")
        return moved

    def squares(self, moved: np.ndarray) -> np.ndarray:
        """The sum of squares of each row; refused where it does not fit 64 bits."""
        if float(np.abs(moved).max(initial=0)) ** 2 * self.length >= 2.0 ** 63:
            exact = [sum(int(v) ** 2 for v in row) for row in moved]
            if max(exact) >= 1 << 63:
                raise ArithmeticError("a deviation does not fit 64 bits")
            return np.array(exact, np.int64)
        return (moved * moved).sum(axis=1)

    def whitened(self, moved: np.ndarray) -> np.ndarray:
        return (moved / self.n) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def _summed(rows: DataFrame, length: int, each, shape: tuple[int, ...], dtype) -> np.ndarray:
    """The sum over all batches of what ``each`` makes of their vectors, an array of ``shape``.

    One array per task; two levels add up FAN_IN of them at a time, so of up to FAN_IN
    squared tasks no task and not the driver holds more.
    """
    def part(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(shape, dtype)
        for batch in batches:
            total = total + each(batch.column("vector"))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "total": pa.array([total.tobytes()])})

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(shape, dtype)
        for packed in table.column("total"):
            total = total + np.frombuffer(packed.as_buffer(), dtype).reshape(shape)
        return pa.table([table.column("part").slice(0, 1), pa.array([total.tobytes()])],
                        ["part", "total"])

    sums = rows.select("vector").mapInArrow(part, "part int, total binary")
    sums = sums.select((F.col("part") / FAN_IN).cast("int").alias("part"), "total")
    sums = sums.groupBy("part").applyInArrow(add, "part int, total binary")
    total = np.zeros(shape, dtype)
    for row in sums.orderBy("part").toLocalIterator():
        total = total + np.frombuffer(bytes(row.total), dtype).reshape(shape)
    return total


def prepared(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows that take part, their vector in column ``vector``, and its length."""
    rows = rows.where(finite(F.col(vector)))
    length = usual_length(rows, vector)
    return rows.where(F.size(vector) == length), length


def fit(rows: DataFrame, vector: str, most: int = 32, factor: int = 64,
        offset: int = 1_000_000) -> Whitening:
    """Learn from all vectors of ``rows`` that take part; entries count as floor(factor * c) + offset.

    Null and empty vectors and those with null or non-finite entries take no part, nor do those whose
    length is not the usual one. At most ``most`` components are kept, fewer where the covariance has fewer
    eigenvalues above rounding; without vectors, none.
    """
    rows, length = prepared(rows, vector)
    rows = rows.select(F.col(vector).alias("vector"))
    if not length:
        return Whitening(0, factor, offset, 0, np.zeros(0, np.int64), 0.0,
                         np.zeros(0), np.zeros((0, 0)), 0.0)

    def sums(column: pa.Array) -> np.ndarray:
        x = scaled(column, length, factor, offset)
        return np.append(x.sum(axis=0), len(x))

    found = _summed(rows, length, sums, (length + 1,), np.int64)
    n, total = int(found[-1]), found[:-1]
    plain = Whitening(length, factor, offset, n, total, 0.0, np.zeros(0),
                      np.zeros((0, length)), 0.0)

    def centred(column: pa.Array) -> np.ndarray:
        moved = plain.deviations(scaled(column, length, factor, offset)) / n
        return moved.T @ moved

    covariance = _summed(rows, length, centred, (length, length), np.float64) / n
    values, vectors = Slicer(covariance).leading(min(most, length))
    model = Whitening(length, factor, offset, n, total, float(np.trace(covariance)), values,
                      vectors, 0.0)
    if not len(values):
        return model

    def after(column: pa.Array) -> np.ndarray:
        z = model.whitened(model.deviations(scaled(column, length, factor, offset)))
        return np.vstack([z.T @ z, z.sum(axis=0)])

    k = len(values)
    second = _summed(rows, length, after, (k + 1, k), np.float64) / n
    left = second[:k] - np.outer(second[k], second[k]) - np.eye(k)
    return Whitening(length, factor, offset, n, total, model.total, values, vectors,
                     float(np.abs(left).max()))


def whiten(rows: DataFrame, vector: str, model: Whitening, carry: tuple[str, ...]) -> DataFrame:
    """For each row that takes part and each component: the columns ``carry``, component (from 1),
    n, deviation, whitened, explained and identity_error.

    ``deviation`` is the sum over entries of (n * x - their sum) squared, exact. Rows are
    handled one by one: repeated rows and null keys come out as often as they go in. Other columns of
    ``rows`` are not read.
    """
    carry = list(carry)
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    schema = (f"{fields}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    given = rows.sparkSession.sparkContext.broadcast(model)  # two rows a component
    taking_part = rows.where(finite(F.col(vector))).where(F.size(vector) == model.length)

    def run(batches: Iterator[pa.RecordBatch]):
        model = given.value
        k = len(model.values)
        explained = model.values / model.total if k else model.values
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            moved = model.deviations(
                scaled(batch.column("vector"), model.length, model.factor, model.offset))
            m = len(moved)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(each) for c in carry),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n)),
                 pa.array(np.repeat(model.squares(moved), k)),
                 pa.array(model.whitened(moved).ravel()),
                 pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, model.identity_error))],
                [*carry, "component", "n", "deviation", "whitened", "explained",
                 "identity_error"])

    return taking_part.select(*carry, F.col(vector).alias("vector")).mapInArrow(run, schema)
