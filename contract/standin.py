"""A title catalogue derived from the given order tables (FIXTURES.md, section 2).

Orders become titles, open orders are series, their lines are episodes; line
items become credits and suppliers people. Every row of the tables is used. Some text
is dirty, as in real dumps: unreadable numbers, ratings given twice, episodes and
credits of unknown titles, and titles longer than a published table takes.
"""

from __future__ import annotations

import threading
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill import run_gold, run_silver, workspace
from playbill import schemas as S
from playbill.plans.layers import CLEANERS, MART_INPUTS, at_once
from playbill.sources import write_delimited, write_layer

# raw files made from lines of open orders too
FROM_LINES = {S.RAW_TITLES, S.RAW_RATINGS, S.RAW_EPISODES}

# most rows of a raw file; it is compressed, so a reader's task takes it whole
FILE_ROWS = 1_000_000


def _text(c: Column) -> Column:
    return c.cast("string")


def _padded(prefix: str, number: Column, width: int) -> Column:
    """The number with leading zeros; a longer one is kept whole."""
    text = _text(number)
    wide = F.greatest(F.lit(width), F.length(text))
    return F.concat(F.lit(prefix), F.lpad(text, wide, F.lit("0")))


def _title_key(order_key: str) -> Column:
    return _padded("tt", F.col(order_key), 9)


def _episode_key() -> Column:
    return F.concat(
        _padded("te", F.col("l_orderkey"), 9), F.lit("-"), _text(F.col("l_linenumber")))


def _quarters(number: Column) -> Column:
    """A rating from 1 to 10 in quarters, which are exact in binary."""
    return (number % 37 + 4) / F.lit(4.0)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The given tables the stand-in reads."""
    return {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in ("orders", "customer", "lineitem", "supplier")
    }


def _open_lines(given: dict[str, DataFrame]) -> DataFrame:
    """Distinct lines of open orders (a line number can occur twice)."""
    open_orders = given["orders"].where("o_orderstatus = 'O'")
    return (
        given["lineitem"]
        .join(open_orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_quantity").alias("quantity"))
    )


def bronze_frames(
    given: dict[str, DataFrame], lines: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Raw file name -> its rows; ``lines`` are those of open orders, if they are stored already."""
    order = F.col("o_orderkey")
    line, number = F.col("l_orderkey"), F.col("l_linenumber")
    lines = _open_lines(given) if lines is None else lines
    null = F.lit(None).cast("string")

    kind = (F.when(F.col("o_orderstatus") == "F", "movie")
            .when(F.col("o_orderstatus") == "O", "tvSeries").otherwise("short"))
    genres = F.when(order % 13 == 0, null).when(
        order % 2 == 0, F.col("c_mktsegment")
    ).otherwise(F.concat_ws(
        ",", "c_mktsegment", F.substring("o_orderpriority", 3, 100)))
    # longer than a published title may be
    long = F.when(order % 43 == 0, F.repeat(F.lit("x"), 600)).otherwise("")
    of_orders = given["orders"].join(
        given["customer"], F.col("o_custkey") == F.col("c_custkey")
    ).select(
        _title_key("o_orderkey").alias("tconst"),
        kind.alias("titleType"),
        F.concat(F.lit("Title "), _text(order % 97), long).alias("primaryTitle"),
        F.lit("orig").alias("originalTitle"),
        F.when(F.col("o_orderpriority") == "5-LOW", "1").otherwise("0").alias("isAdult"),
        F.when(order % 19 == 0, "19x5").when(
            order % 11 != 0, _text(F.year("o_orderdate"))).alias("startYear"),
        null.alias("endYear"),
        F.when(order % 17 == 0, "n/a").when(
            order % 7 != 0, _text(order % 180 + 1)).alias("runtimeMinutes"),
        genres.alias("genres"),
    )
    of_lines = lines.select(
        _episode_key().alias("tconst"),
        F.lit("tvEpisode").alias("titleType"),
        F.concat(F.lit("Episode "), _text(number)).alias("primaryTitle"),
        F.lit("orig").alias("originalTitle"),
        F.lit("0").alias("isAdult"),
        F.when(line % 5 != 0, _text((line + number) % 9 + 1995)).alias("startYear"),
        null.alias("endYear"),
        _text(number * 5 + 15).alias("runtimeMinutes"),
        null.alias("genres"),
    )
    order_ratings = given["orders"].where(
        "o_orderpriority <> '4-NOT SPECIFIED'"
    ).select(
        _title_key("o_orderkey").alias("tconst"),
        F.when(order % 23 == 0, "n/a").otherwise(
            _text(_quarters(order * 7))).alias("averageRating"),
        (order * 37 % 50000).alias("numVotes"),
    )
    # some titles are rated twice
    again = order_ratings.where(F.substring("tconst", 3, 100).cast("bigint") % 41 == 0).select(
        "tconst", "averageRating", (F.col("numVotes") + 1).alias("numVotes"))
    line_ratings = lines.where("quantity >= 10").select(
        _episode_key().alias("tconst"),
        _text(_quarters(line * 3 + number * 5)).alias("averageRating"),
        ((line + number) * 13 % 3000).alias("numVotes"),
    )
    episodes = lines.select(
        _episode_key().alias("tconst"),
        F.when((line + number) % 31 == 0, "tt-none").otherwise(
            _title_key("l_orderkey")).alias("parentTconst"),
        F.when(number != 7, _text(number % 3 + 1)).alias("seasonNumber"),
        _text(number).alias("episodeNumber"),
    )
    category = (F.when(F.col("l_returnflag") == "A", "actor")
                .when(F.col("l_returnflag") == "R", "actress").otherwise("director"))
    person = F.when(F.col("l_partkey") % 29 == 0, F.lit(-1)).otherwise(F.col("l_suppkey"))
    credits = given["lineitem"].select(
        F.when(line % 37 == 0, "tt-gone").otherwise(_title_key("l_orderkey")).alias("tconst"),
        number.alias("ordering"),
        _padded("nm", person, 7).alias("nconst"),
        category.alias("category"),
        null.alias("job"),
        F.when(F.col("l_returnflag") != "N", F.concat(
            F.lit('["P'), _text(F.col("l_partkey")), F.lit('"]'))).alias("characters"),
    )
    people = given["supplier"].select(
        _padded("nm", F.col("s_suppkey"), 7).alias("nconst"),
        F.concat(F.lit("Person "), _text(F.col("s_suppkey") % 60)).alias("primaryName"),
        *[null.alias(c) for c in S.RAW_PEOPLE.columns[2:]],
    )
    return {
        S.RAW_TITLES.name: of_orders.unionAll(of_lines),
        S.RAW_RATINGS.name: order_ratings.unionAll(again).unionAll(line_ratings),
        S.RAW_EPISODES.name: episodes,
        S.RAW_CREDITS.name: credits,
        S.RAW_PEOPLE.name: people,
    }


class Lake:
    """Layers of the stand-in, each table built from whole inputs when first asked for."""

    def __init__(self, spark: SparkSession, given: dict[str, DataFrame], root: str):
        self.spark, self.root = spark, root
        self.bronze, self.silver, self.gold = (
            f"{root}/{layer}" for layer in ("bronze", "silver", "gold"))
        self._given = given
        self._lines: DataFrame | None = None
        self._done: set[str] = set()
        self._lock = threading.RLock()

    def _missing(self, tables: Collection[S.Table]) -> list[S.Table]:
        return [t for t in tables if t.name not in self._done]

    def _finish(self, tables: Collection[S.Table]) -> None:
        self._done.update(t.name for t in tables)

    def _frames(self, tables: Collection[S.Table]) -> dict[str, DataFrame]:
        """Rows of raw ``tables``; lines of open orders are found once and kept, as three files need them."""
        if self._lines is None and not FROM_LINES.isdisjoint(tables):
            write_layer(_open_lines(self._given), f"{self.root}/lines")
            self._lines = self.spark.read.parquet(f"{self.root}/lines")
        return bronze_frames(self._given, self._lines)

    def with_raw(self, *tables: S.Table) -> str:
        """The raw folder, with text files for ``tables``."""
        with self._lock:
            todo = self._missing(tables)
            frames = self._frames(todo)
            at_once(lambda t: write_delimited(
                frames[t.name].select(*t.columns), f"{self.bronze}/{t.name}",
                compression="lz4", max_rows=FILE_ROWS), todo)
            self._finish(todo)
        return self.bronze

    def with_silver(self, *tables: S.Table) -> str:
        """The Silver folder, with ``tables``."""
        with self._lock:
            todo = self._missing(tables)
            if todo:
                self.with_raw(*(raw for raw, t, _ in CLEANERS if t in todo))
                run_silver(self.spark, self.bronze, self.silver, todo)
            self._finish(todo)
        return self.silver

    def with_gold(self, *marts: S.Table) -> str:
        """The Gold folder, with ``marts``."""
        with self._lock:
            todo = self._missing((S.TITLES, *marts))
            if todo:
                inputs = {t: None for mart in todo for t in MART_INPUTS[mart]}
                self.with_silver(*inputs)
                run_gold(self.spark, self.silver, self.gold, dict.fromkeys(todo))
            self._finish(todo)
        return self.gold


_lakes: dict[tuple[str, str], Lake] = {}
_lock = threading.Lock()


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The stand-in over ``sf_dir``, kept for the life of the application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _lakes:
            _lakes[key] = Lake(spark, tables(spark, sf_dir), workspace(spark))
        return _lakes[key]
