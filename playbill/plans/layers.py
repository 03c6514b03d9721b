"""Bronze to Silver to Gold to published tables.

Each layer is written before the next one reads it: that cuts lineage, and a
lost executor costs a re-read of Parquet, not a re-parse of text.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill import schemas as S
from playbill.operators import (
    clean_credits, clean_episodes, clean_people, clean_ratings, clean_titles,
    enrich_credits, enrich_episodes, enrich_titles, ensure_database, publish,
)
from playbill.sources import corrupt_count, read_delimited, read_layer, write_layer

T = TypeVar("T")
R = TypeVar("R")

# raw file -> Silver table and the cleaner between them
CLEANERS: tuple[tuple[S.Table, S.Table, Callable[[DataFrame], DataFrame]], ...] = (
    (S.RAW_TITLES, S.SILVER_TITLES, clean_titles),
    (S.RAW_RATINGS, S.SILVER_RATINGS, clean_ratings),
    (S.RAW_EPISODES, S.SILVER_EPISODES, clean_episodes),
    (S.RAW_CREDITS, S.SILVER_CREDITS, clean_credits),
    (S.RAW_PEOPLE, S.SILVER_PEOPLE, clean_people),
)

# cleaners of tables with integers in their text
TYPED = (clean_titles, clean_episodes)

# mart -> the Silver tables it reads (besides the titles mart)
MART_INPUTS: dict[S.Table, tuple[S.Table, ...]] = {
    S.TITLES: (S.SILVER_TITLES, S.SILVER_RATINGS),
    S.EPISODES: (S.SILVER_EPISODES,),
    S.CREDITS: (S.SILVER_CREDITS, S.SILVER_PEOPLE),
}


def read_raw(spark: SparkSession, bronze: str, table: S.Table, **options) -> DataFrame:
    """One raw file under its declared schema."""
    return read_delimited(spark, f"{bronze}/{table.name}", table.ddl, **options)


def at_once(action: Callable[[T], R], items: Collection[T]) -> list[R]:
    """Submit independent jobs together, so none waits for another's stragglers."""
    with ThreadPoolExecutor(max(1, len(items))) as pool:
        return list(pool.map(action, items))


def _write(root: str, table: S.Table, df: DataFrame) -> None:
    write_layer(df.select(*table.columns), f"{root}/{table.name}",
                table.partition_by, table.sort_by)


def run_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    tables: Collection[S.Table] = S.SILVER,
    truncate: bool = False,
    **options,
) -> None:
    """Clean the raw files into ``tables``. All must exist before any is written.

    ``options`` go to the reader (``quote``, ``strict_header``, ``sep``, ``null_token``); with
    ``truncate`` decimals in integer columns read as their whole part.
    """
    cleaned = [
        (table, clean(read_raw(spark, bronze, raw, **options),
                      **({"truncate": True} if truncate and clean in TYPED else {})))
        for raw, table, clean in CLEANERS if table in tables
    ]
    at_once(lambda item: _write(silver, *item), cleaned)


def corrupt_counts(spark: SparkSession, bronze: str, **options) -> DataFrame:
    """Rows of (table_name, row_count, corrupt_count), one per raw file."""
    return reduce(DataFrame.unionAll, [
        corrupt_count(spark, f"{bronze}/{t.name}", t.ddl, t.columns, **options)
        .select(F.lit(t.name).alias("table_name"), "row_count", "corrupt_count")
        for t in S.BRONZE
    ])


def run_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    marts: Collection[S.Table] = S.GOLD,
    parent_fallback: bool = False,
) -> None:
    """Build ``marts``; episodes and credits read the finished titles mart.

    With ``parent_fallback`` an episode without a year takes its series' decade.
    """
    read = partial(read_layer, spark, silver)
    if S.TITLES in marts:
        _write(gold, S.TITLES, enrich_titles(read(S.SILVER_TITLES), read(S.SILVER_RATINGS)))
    titles = read_layer(spark, gold, S.TITLES)
    joined: list[tuple[S.Table, DataFrame]] = []
    if S.EPISODES in marts:
        joined.append((S.EPISODES, enrich_episodes(
            read(S.SILVER_EPISODES), titles, parent_fallback)))
    if S.CREDITS in marts:
        joined.append((S.CREDITS, enrich_credits(
            read(S.SILVER_CREDITS), titles, read(S.SILVER_PEOPLE))))
    at_once(lambda item: _write(gold, *item), joined)


def run_all(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold: str,
    truncate: bool = False,
    parent_fallback: bool = False,
    **options,
) -> None:
    """The whole run. Every table is overwritten, so a repeat changes nothing."""
    run_silver(spark, bronze, silver, truncate=truncate, **options)
    run_gold(spark, silver, gold, parent_fallback=parent_fallback)


def publish_gold(
    spark: SparkSession,
    gold: str,
    database: str,
    location: str | None = None,
    mode: str = "overwrite",
    **layout,
) -> DataFrame:
    """Publish the three marts; returns one audit row per mart.

    ``layout`` goes to ``publish``: ``buckets`` and ``layout``.
    """
    ensure_database(spark, database, location)
    audits = at_once(
        lambda t: publish(read_layer(spark, gold, t), t, database, mode, **layout), S.GOLD)
    return reduce(DataFrame.unionAll, audits)
