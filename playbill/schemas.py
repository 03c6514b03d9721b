"""Declared tables of the lake: raw files, Silver tables, Gold marts.

Everything in this module is fixed by the data formats: field names, types,
length limits, partition columns and bucket keys.
"""

from __future__ import annotations

from dataclasses import dataclass

NULL_TOKEN = "\\N"
UNKNOWN = "unknown"


@dataclass(frozen=True)
class Field:
    """One column. ``limit`` counts UTF-8 bytes (of each element for arrays).

    The published types are VARCHAR(n) of a store that counts bytes there.
    """

    name: str
    type: str = "string"
    limit: int | None = None
    required: bool = False


@dataclass(frozen=True)
class Table:
    """A declared table; partition columns come last, as they are read back."""

    name: str
    fields: tuple[Field, ...]
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0
    # order of the rows within a published bucket
    publish_order: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)


def _texts(*names: str) -> tuple[Field, ...]:
    return tuple(Field(name) for name in names)


# ---- raw files: tab separated, one header line, \N for NULL ----------------

RAW_TITLES = Table("title.basics.tsv", _texts(
    "tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
    "startYear", "endYear", "runtimeMinutes", "genres"))
RAW_RATINGS = Table("title.ratings.tsv", (
    Field("tconst"), Field("averageRating", "double"), Field("numVotes", "bigint")))
RAW_EPISODES = Table("title.episode.tsv", _texts(
    "tconst", "parentTconst", "seasonNumber", "episodeNumber"))
RAW_CREDITS = Table("title.principals.tsv", (
    Field("tconst"), Field("ordering", "int"), Field("nconst"), Field("category"),
    Field("job"), Field("characters")))
RAW_PEOPLE = Table("name.basics.tsv", _texts(
    "nconst", "primaryName", "birthYear", "deathYear", "primaryProfession",
    "knownForTitles"))

BRONZE = (RAW_TITLES, RAW_RATINGS, RAW_EPISODES, RAW_CREDITS, RAW_PEOPLE)

# ---- Silver ----------------------------------------------------------------

SILVER_TITLES = Table("title_basics", (
    Field("tconst"), Field("primaryTitle"), Field("isAdult", "int"),
    Field("startYear", "int"), Field("endYear", "int"), Field("runtimeMinutes", "int"),
    Field("genres"), Field("genres_array", "array<string>"), Field("primary_genre"),
    Field("titleType"), Field("start_decade")),
    partition_by=("titleType", "start_decade"))
SILVER_RATINGS = Table("title_ratings", RAW_RATINGS.fields)
SILVER_EPISODES = Table("title_episode", (
    Field("tconst"), Field("parentTconst"), Field("seasonNumber", "int"),
    Field("episodeNumber", "int")))
SILVER_CREDITS = Table("title_principals", _texts(
    "tconst", "nconst", "characters", "category"), partition_by=("category",))
SILVER_PEOPLE = Table("name_basics", _texts("nconst", "primaryName"))

SILVER = (SILVER_TITLES, SILVER_RATINGS, SILVER_EPISODES, SILVER_CREDITS,
          SILVER_PEOPLE)

# ---- Gold marts; limits and required keys apply when a mart is published ---

TITLES = Table("titles_enriched", (
    Field("tconst", limit=20, required=True),
    Field("primaryTitle", limit=500),
    Field("isAdult", "int"),
    Field("startYear", "int"),
    Field("endYear", "int"),
    Field("runtimeMinutes", "int"),
    Field("genres", limit=200),
    Field("genres_array", "array<string>", limit=50),
    Field("primary_genre", limit=50),
    Field("averageRating", "double"),
    Field("numVotes", "bigint"),
    Field("is_rated", "boolean"),
    Field("titleType", limit=32),
    Field("start_decade", limit=16)),
    partition_by=("titleType", "start_decade"),
    # row groups get narrow vote ranges, so "votes >= n" can skip them
    sort_by=("numVotes",),
    bucket_by="tconst", buckets=8, publish_order=("tconst",))

EPISODES = Table("episodes_enriched", (
    Field("tconst", limit=20, required=True),
    Field("parentTconst", limit=20),
    Field("seasonNumber", "int"),
    Field("episodeNumber", "int"),
    Field("episodeTitle", limit=500),
    Field("seriesTitle", limit=500),
    Field("episodeStartYear", "int"),
    Field("seriesStartYear", "int"),
    Field("episodeRuntimeMinutes", "int"),
    Field("seriesRuntimeMinutes", "int"),
    Field("episodeGenres", limit=200),
    Field("seriesGenres", limit=200),
    Field("episodePrimaryGenre", limit=50),
    Field("seriesPrimaryGenre", limit=50),
    Field("episodeAverageRating", "double"),
    Field("episodeNumVotes", "bigint"),
    Field("seriesAverageRating", "double"),
    Field("seriesNumVotes", "bigint"),
    Field("start_decade", limit=16)),
    partition_by=("start_decade",),
    # rows of one series lie together, so its repeated columns compress well
    sort_by=("parentTconst",),
    bucket_by="parentTconst", buckets=8, publish_order=("tconst",))

CREDITS = Table("cast_credits", (
    Field("tconst", limit=20, required=True),
    Field("nconst", limit=20, required=True),
    Field("characters", limit=1000),
    Field("primaryName", limit=300),
    Field("titleType", limit=32),
    Field("primaryTitle", limit=500),
    Field("startYear", "int"),
    Field("start_decade", limit=16),
    Field("primary_genre", limit=50),
    Field("averageRating", "double"),
    Field("numVotes", "bigint"),
    Field("category", limit=50, required=True)),
    partition_by=("category",),
    sort_by=("tconst",),
    bucket_by="tconst", buckets=16, publish_order=("tconst", "nconst", "category"))

GOLD = (TITLES, EPISODES, CREDITS)
