"""The three Gold marts.

Ratings are joined to titles once. The episode and credit marts then take
titles with their ratings from that mart, which gives the same rows as joining
titles and ratings separately in each role: five joins instead of eight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from playbill.functions import decade, first_known
from playbill.operators.joins import enrich, with_role
from playbill.schemas import CREDITS, EPISODES, TITLES, UNKNOWN

# title attribute -> its name after the role prefix
ROLE_SUFFIX = {
    "primaryTitle": "Title",
    "startYear": "StartYear",
    "runtimeMinutes": "RuntimeMinutes",
    "genres": "Genres",
    "primary_genre": "PrimaryGenre",
    "averageRating": "AverageRating",
    "numVotes": "NumVotes",
}


def enrich_titles(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every title with its rating, if any. A rating without a value is unrated."""
    rated = enrich(basics, ratings, "tconst", ("is_rated", "averageRating"))
    return rated.select(*TITLES.columns)


def enrich_episodes(
    episodes: DataFrame, titles: DataFrame, parent_fallback: bool = False
) -> DataFrame:
    """Episodes whose own title and series exist, with both sides' attributes.

    ``start_decade`` is the episode's. With ``parent_fallback`` an unknown one is
    taken from the series. It is derived from the start year rather than read,
    so both roles need the same title columns and Spark scans and shuffles
    titles once for the two joins.
    """
    roles = {
        prefix: {source: prefix + suffix for source, suffix in ROLE_SUFFIX.items()}
        for prefix in ("episode", "series")
    }
    both = episodes.transform(
        with_role, titles, "tconst", "tconst", roles["episode"]
    ).transform(with_role, titles, "parentTconst", "tconst", roles["series"])
    return both.withColumn(
        "start_decade", episode_decade(parent_fallback)
    ).select(*EPISODES.columns)


def episode_decade(parent_fallback: bool = False) -> Column:
    """Decade of an enriched episode, optionally falling back to its series."""
    own = decade("episodeStartYear")
    if not parent_fallback:
        return own
    return first_known(own, decade("seriesStartYear"), missing=UNKNOWN)


def enrich_credits(
    principals: DataFrame, titles: DataFrame, people: DataFrame
) -> DataFrame:
    """Credits whose title and person exist, with title, rating and name.

    People are joined first: that adds one column, so the second shuffle of the
    largest table stays narrow.
    """
    of_title = ("titleType", "primaryTitle", "startYear", "start_decade",
                "primary_genre", "averageRating", "numVotes")
    return (
        principals
        .transform(with_role, people, "nconst", "nconst", {"primaryName": "primaryName"})
        .transform(with_role, titles, "tconst", "tconst", {c: c for c in of_title})
        .select(*CREDITS.columns)
    )
