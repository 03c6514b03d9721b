"""The six named analytic queries over the Gold marts.

Thresholds and sizes are parameters. Every query that keeps k rows ends its
sort with a unique key, so that ties at the cut are settled the same way in
every run. Groups are formed by title or name, as asked, so people or series
that share a name count together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.operators.topk import keep_top_groups, top_groups, top_rows
from playbill.schemas import CREDITS, EPISODES, TITLES


def top_movies(
    titles: DataFrame, title_type: str = "movie", min_votes: int = 10_000, k: int = 20
) -> DataFrame:
    """Best rated titles of one type among those with enough votes."""
    wanted = titles.where(
        (F.col("titleType") == title_type) & (F.col("numVotes") >= min_votes))
    order = [F.desc("averageRating"), F.desc("numVotes"), F.asc("tconst")]
    return top_rows(wanted, order, k).select(
        "primaryTitle", "averageRating", "numVotes", "startYear")


def season_episodes(episodes: DataFrame, k: int = 10) -> DataFrame:
    """Episodes per season of the ``k`` series with the most votes."""
    return (
        keep_top_groups(episodes, "parentTconst", "seriesNumVotes", k)
        .groupBy("seriesTitle", "seasonNumber")
        .agg(F.count("*").alias("episode_count"))
        .orderBy("seriesTitle", "seasonNumber")
    )


def genre_decade_rating(titles: DataFrame) -> DataFrame:
    """Average rating and number of rated titles per genre and decade."""
    return top_groups(
        titles.where(F.col("primary_genre").isNotNull() & F.col("averageRating").isNotNull()),
        ["primary_genre", "start_decade"],
        [F.avg("averageRating").alias("avg_rating"), F.count("*").alias("title_count")],
        [F.asc("start_decade"), F.desc("avg_rating"), F.asc("primary_genre")],
    )


def rating_gap(episodes: DataFrame, min_episodes: int = 10, k: int = 20) -> DataFrame:
    """Series whose episodes are rated furthest above the series itself."""
    own, series = F.avg("episodeAverageRating"), F.avg("seriesAverageRating")
    return top_groups(
        episodes.where(
            F.col("episodeAverageRating").isNotNull() & F.col("seriesAverageRating").isNotNull()),
        ["seriesTitle"],
        [own.alias("avg_episode_rating"), series.alias("avg_series_rating"),
         (own - series).alias("rating_gap")],
        [F.desc("rating_gap"), F.asc("seriesTitle")],
        k, min_episodes,
    )


def top_credited(
    credits: DataFrame, categories: Sequence[str] = ("actor", "actress"), k: int = 25
) -> DataFrame:
    """People with the most credits in the given categories."""
    return top_groups(
        credits.where(F.col("category").isin(*categories)),
        ["primaryName"],
        [F.count("*").alias("credit_count")],
        [F.desc("credit_count"), F.asc("primaryName")],
        k,
    )


def runtime_by_type_decade(titles: DataFrame) -> DataFrame:
    """Average runtime per title type and decade."""
    return top_groups(
        titles.where(F.col("runtimeMinutes").isNotNull()),
        ["titleType", "start_decade"],
        [F.avg("runtimeMinutes").alias("avg_runtime_minutes"),
         F.count("*").alias("title_count")],
        [F.asc("start_decade"), F.asc("titleType")],
    )


# query name -> (mart it reads, function over that mart)
SUITE: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "q1_top_movies": (TITLES.name, top_movies),
    "q2_season_episodes": (EPISODES.name, season_episodes),
    "q3_genre_decade_rating": (TITLES.name, genre_decade_rating),
    "q4_rating_gap": (EPISODES.name, rating_gap),
    "q5_top_credited": (CREDITS.name, top_credited),
    "q6_runtime_by_type_decade": (TITLES.name, runtime_by_type_decade),
}


def run_query(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run a named query over the registered views (or published tables)."""
    mart, query = SUITE[name]
    return query(spark.table(mart), **params)
