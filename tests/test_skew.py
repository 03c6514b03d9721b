"""A whole run in which one key of each kind holds a third of the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from playbill import run_all
from playbill.operators import enrich_credits, enrich_episodes
from playbill.schemas import (
    BRONZE, CREDITS, EPISODES, GOLD, RAW_CREDITS, RAW_EPISODES, RAW_PEOPLE, RAW_RATINGS,
    RAW_TITLES, SILVER, TITLES,
)
from playbill.sources import read_layer, write_delimited
from tests.helpers import plan

N = 6000


def _key(prefix, number):
    return F.concat(F.lit(prefix), number.cast("string"))


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skewed"))
    i = F.col("id")

    def hot(spread):
        """0 for every third row, else one of ``spread`` values."""
        return F.when(i % 3 == 0, 0).otherwise(i % spread)

    rows = spark.range(0, N, numPartitions=6)
    text = {c: F.lit(None).cast("string") for c in ("originalTitle", "endYear", "job")}
    frames = {
        RAW_TITLES: rows.select(
            _key("t", i).alias("tconst"),
            F.when(i % 3 == 0, "movie").otherwise("tvEpisode").alias("titleType"),
            _key("Title ", i % 11).alias("primaryTitle"), text["originalTitle"].alias("originalTitle"),
            F.lit("0").alias("isAdult"), (1950 + i % 60).cast("string").alias("startYear"),
            text["endYear"].alias("endYear"), F.lit("90").alias("runtimeMinutes"),
            F.when(i % 4 != 0, "Drama,War").alias("genres")),
        RAW_RATINGS: rows.select(
            _key("t", hot(N)).alias("tconst"), (i % 37 / 4.0).alias("averageRating"),
            (i % 5).alias("numVotes")),
        RAW_EPISODES: rows.select(
            _key("t", i + 1).alias("tconst"), _key("t", hot(N) + 2).alias("parentTconst"),
            (i % 4).cast("string").alias("seasonNumber"),
            i.cast("string").alias("episodeNumber")),
        RAW_CREDITS: rows.select(
            _key("t", hot(N + 50) + 1).alias("tconst"), i.cast("int").alias("ordering"),
            _key("n", F.when(i % 5 < 2, 0).otherwise(i % 700)).alias("nconst"),
            F.when(i % 3 == 0, "actor").otherwise(_key("other", i % 4)).alias("category"),
            text["job"].alias("job"), _key("P", i).alias("characters")),
        RAW_PEOPLE: spark.range(600).select(
            _key("n", i).alias("nconst"), _key("Person ", i % 50).alias("primaryName"),
            *[F.lit(None).cast("string").alias(c) for c in RAW_PEOPLE.columns[2:]]),
    }
    assert set(frames) == set(BRONZE)
    for table, df in frames.items():
        write_delimited(df, f"{root}/{table.name}")
    return root


def _times(df, key):
    """Rows per key."""
    return Counter({r[key]: r["count"] for r in df.groupBy(key).count().collect()})


def test_whole_run_over_skewed_files(spark, bronze, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    # several tasks write each shuffle, as with more data; what one task wrote is not split
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.files.openCostInBytes", "128m")
    silver, gold = f"{tmp_path}/silver", f"{tmp_path}/gold"
    run_all(spark, bronze, silver, gold)

    names = ("basics", "ratings", "episodes", "credits", "people")
    given = {n: read_layer(spark, silver, t) for n, t in zip(names, SILVER)}
    rated, by_person = _times(given["ratings"], "tconst"), _times(given["people"], "nconst")
    known = _times(given["basics"], "tconst")
    # how often each row of a mart's fact must come out, by the ratings of its titles
    expected = {
        TITLES: sum(max(1, rated[r["tconst"]]) for r in given["basics"].select("tconst").collect()),
        EPISODES: sum(
            known[r[0]] * known[r[1]] * max(1, rated[r[0]]) * max(1, rated[r[1]])
            for r in given["episodes"].select("tconst", "parentTconst").collect()),
        CREDITS: sum(
            known[r[0]] * by_person[r[1]] * max(1, rated[r[0]])
            for r in given["credits"].select("tconst", "nconst").collect()),
    }
    assert {m: read_layer(spark, gold, m).count() for m in GOLD} == expected
    assert {m: read_layer(spark, gold, m).count() > N / 2 for m in GOLD} == dict.fromkeys(
        (TITLES, EPISODES, CREDITS), True)

    # the hot series and the hot person are split over tasks
    rated = read_layer(spark, gold, TITLES)
    for mart in (enrich_episodes(given["episodes"], rated),
                 enrich_credits(given["credits"], rated, given["people"])):
        mart.collect()
        assert "skew=true" in plan(mart).split("Initial Plan")[0]
