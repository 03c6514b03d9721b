"""Raw rows to typed Silver rows; projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playbill.functions import decade, first_of, split_list, to_int
from playbill.schemas import SILVER_CREDITS, SILVER_PEOPLE, SILVER_RATINGS


def clean_titles(df: DataFrame, truncate: bool = False) -> DataFrame:
    """Drop the original title, type four columns, add decade and genre columns.

    With ``truncate`` a decimal reads as its whole part, else as NULL.
    """
    integers = ("isAdult", "startYear", "endYear", "runtimeMinutes")
    return (
        df.drop("originalTitle")
        .withColumns({c: to_int(c, truncate) for c in integers})
        .withColumns({
            "start_decade": decade("startYear"),
            "genres_array": split_list("genres"),
        })
        .withColumn("primary_genre", first_of("genres_array"))
    )


def clean_ratings(df: DataFrame) -> DataFrame:
    """Ratings arrive typed from the reader."""
    return df.select(*SILVER_RATINGS.columns)


def clean_episodes(df: DataFrame, truncate: bool = False) -> DataFrame:
    """Type season and episode numbers; ``truncate`` as for titles."""
    return df.withColumns({c: to_int(c, truncate) for c in ("seasonNumber", "episodeNumber")})


def clean_credits(df: DataFrame) -> DataFrame:
    """Keep who did what in which title."""
    return df.select(*SILVER_CREDITS.columns)


def clean_people(df: DataFrame) -> DataFrame:
    """Keep each person's key and name."""
    return df.select(*SILVER_PEOPLE.columns)
