"""Exact top-k search by inner product: aggregation of sorted lists without random access.

Of each block of candidates every dimension is a list sorted by value. A query reads all lists side
by side from the end that suits its sign, some rows at a time, and keeps what each candidate has
scored so far. What the lists still hold bounds the rest: from the last value read for the upper bound, from
the other end of the list for the lower one. Reading stops when all but a few candidates cannot
come among the k best any more, by their upper bound and the k-th lower bound, which a
task takes along from block to block; the final scores of those few are then resolved.

Queries are taken in blocks of bounded size, each sent to where the candidates are: one pass over the
candidates for each block, which emits k rows for each query and task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playbill.llm.vectors import finite, scaled, usual_length

#: bytes of query vectors sent to the tasks at once
QUERY_BYTES = 4 << 20
#: candidates whose lists are sorted together
BLOCK = 8192
#: shares of the lists after which bounds are compared
STEPS = 8
#: queries that read the lists at once
TOGETHER = 16
#: candidates left whose scores are resolved instead of reading on, as a multiple of k
LEFT = 8


class Lists:
    """A block of candidates: ids and rows, and every dimension's list, from its least value."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.x, self.ids, self.rows = x, ids, rows
        self.order = np.argsort(x, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(x.T, self.order, axis=1).astype(np.float64)
        #: where each list has a candidate
        self.place = np.empty(x.shape, np.int32)
        np.put_along_axis(self.place.T, self.order, np.arange(len(x), dtype=np.int32)[None], axis=1)

    def best(
        self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray
    ) -> list[np.ndarray]:
        """For each query, the candidates among which the k best of those not below its floor are.

        ``own`` has the rows of the queries, which are no candidates of theirs; a floor is the score
        of the k-th best known so far.
        """
        n, result = len(self.x), [np.zeros(0, np.int64)] * len(queries)
        least, most = self.values[:, :1], self.values[:, -1:]
        # a query reads from the top where it is positive, and from the bottom where negative
        down = np.maximum(queries, 0).T.astype(np.float64)
        up = np.minimum(queries, 0).T.astype(np.float64)
        lower = np.tile((down * least + up * most).sum(axis=0), (n, 1))
        open_, floors = np.arange(len(queries)), floors.copy()
        for column in open_:
            lower[self.rows == own[column], column] = -np.inf
        step = max(1, math.ceil(n / STEPS))
        for read in range(0, n, step):
            stop = min(n, read + step)
            for order, values, q_down, q_up in zip(self.order, self.values, down, up):
                top, bottom = slice(n - stop, n - read), slice(read, stop)
                lower[order[top]] += np.outer(values[top] - values[0], q_down)
                lower[order[bottom]] += np.outer(values[bottom] - values[-1], q_up)
            upper = lower
            if stop < n:  # what is not read is no better than what was read last
                upper = lower + (self.place < n - stop) @ (
                    down * (self.values[:, n - stop, None] - least))
                upper += (self.place >= stop) @ (up * (self.values[:, stop - 1, None] - most))
            if n >= k:
                floors = np.maximum(floors, np.partition(lower, n - k, axis=0)[n - k])
            inside = (upper >= floors) & (lower > -np.inf)
            over = inside.sum(axis=0) <= (LEFT * k if stop < n else n)
            for column in np.flatnonzero(over):
                result[open_[column]] = np.flatnonzero(inside[:, column])
            if over.any():
                rest = ~over
                open_, floors, lower = open_[rest], floors[rest], lower[:, rest]
                down, up = down[:, rest], up[:, rest]
            if not len(open_):
                break
        return result


def _merged(best: tuple[np.ndarray, ...], more: tuple[np.ndarray, ...], k: int):
    """The k best of two sets of (scores, ids, rows), ties to smaller ids."""
    score, ids, rows = (np.concatenate(pair) for pair in zip(best, more))
    order = np.lexsort((rows, ids, -score))[:k]
    return score[order], ids[order], rows[order]


def search(block: pa.Table, queries: tuple[np.ndarray, np.ndarray], state: list, k: int) -> None:
    """Bring the best of each query, held in ``state``, up to date with a block of candidates."""
    length = queries[1].shape[1]
    x = block.column("x").combine_chunks().flatten().to_numpy().reshape(-1, length)
    most = float(np.abs(x).max(initial=0)) * float(np.abs(queries[1]).max(initial=0)) * length
    if most >= 2.0 ** 53:
        raise ArithmeticError("scores of these components are not exact")
    lists = Lists(x, block.column("vec_id").to_numpy(), block.column("row").to_numpy())
    for begin in range(0, len(queries[0]), TOGETHER):
        own, asked = (part[begin:begin + TOGETHER] for part in queries)
        floors = np.array([
            float(score[-1]) if len(score) == k else -np.inf
            for score, _, _ in state[begin:begin + TOGETHER]])
        for number, at in enumerate(lists.best(asked, own, k, floors), begin):
            if len(at):
                state[number] = _merged(state[number], (
                    lists.x[at] @ queries[1][number], lists.ids[at], lists.rows[at]), k)


def _store(rows: DataFrame, vec_id: str, vector: str, factor: int, path: str) -> int:
    """Store row (a number of its own), vec_id and x of all rows that take part; returns the length of x."""
    rows = rows.where(finite(F.col(vector)) & F.col(vec_id).isNotNull())
    length = usual_length(rows, vector)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = scaled(batch.column("vector"), length, factor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"),
                 pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), max(length, 1)).cast(
                     pa.list_(pa.int64()))], ["vec_id", "x"])

    (rows.where(F.size(vector) == length)
     .select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
     .mapInArrow(run, "vec_id bigint, x array<bigint>").write.parquet(path))
    return length


def _numbered(stored: DataFrame) -> DataFrame:
    """Rows of stored files with a number that is theirs alone, the same whenever they are read."""
    metadata = stored.metadataColumn("_metadata")
    return stored.select(
        F.xxhash64(metadata["file_path"], metadata["row_index"]).alias("row"), "vec_id", "x")


def top_k(
    rows: DataFrame, work: str, divisor: int = 100, k: int = 10, vec_id: str = "vec_id",
    vector: str = "embedding", factor: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of each query.

    Queries are the rows whose id is divisible by ``divisor``, candidates all rows but the query's
    own; entries count as floor(factor * c), the score is the inner product, ties go to the
    smaller id. Null and empty vectors and those with null or non-finite entries
    take no part, nor do rows without id and those whose length is not the usual one. Rows
    that repeat an id are queries and candidates of their own. Other columns of ``rows`` are not
    read. ``work`` is an unused folder that all executors share.
    """
    spark = rows.sparkSession
    length = _store(rows, vec_id, vector, factor, f"{work}/candidates")
    _numbered(spark.read.parquet(f"{work}/candidates")).write.parquet(f"{work}/numbered")
    candidates = spark.read.parquet(f"{work}/numbered")
    asked = candidates.where(F.col("vec_id") % divisor == 0)
    blocks = math.ceil(asked.count() * max(length, 1) * 8 / QUERY_BYTES)
    (asked.withColumn("block", F.pmod("row", F.lit(max(blocks, 1))).cast("int"))
     .repartition("block").write.partitionBy("block").parquet(f"{work}/queries"))
    schema = "query bigint, query_id bigint, vec_id bigint, score bigint, row bigint"
    # rows fall into blocks by hash, so one may have none
    filled = [row["block"] for row in spark.read.parquet(f"{work}/queries").select(
        "block").distinct().collect()] if blocks else []
    for number in filled:
        _pass(spark, candidates, f"{work}/queries/block={number}", length, k, schema).write.parquet(
            f"{work}/best/block={number}")
    if filled:
        found = spark.read.schema(schema).parquet(
            *(f"{work}/best/block={number}" for number in filled))
    else:
        found = spark.createDataFrame([], schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _pass(
    spark: SparkSession, candidates: DataFrame, path: str, length: int, k: int, schema: str
) -> DataFrame:
    """The best candidates of each task for one block of queries, about QUERY_BYTES of them."""
    asked = spark.read.parquet(path).toArrow()
    ids = asked.column("vec_id").to_numpy()
    x = asked.column("x").combine_chunks().flatten().to_numpy().reshape(-1, length)
    given = spark.sparkContext.broadcast((asked.column("row").to_numpy(), ids, x))

    def run(batches: Iterator[pa.RecordBatch]):
        own, ids, x = given.value
        empty = tuple(np.zeros(0, np.int64) for _ in range(3))
        state, waiting, size = [empty] * len(own), [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                waiting.append(batch.slice(begin, BLOCK))
                size += waiting[-1].num_rows
                if size >= BLOCK:
                    search(pa.Table.from_batches(waiting), (own, x), state, k)
                    waiting, size = [], 0
        if size:
            search(pa.Table.from_batches(waiting), (own, x), state, k)
        counts = [len(score) for score, _, _ in state]
        if sum(counts):
            score, vec_id, row = (np.concatenate(part) for part in zip(*state))
            yield pa.RecordBatch.from_pydict({
                "query": np.repeat(own, counts), "query_id": np.repeat(ids, counts),
                "vec_id": vec_id, "score": score, "row": row})

    return candidates.mapInArrow(run, schema)
