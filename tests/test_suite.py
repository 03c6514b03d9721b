import pytest
from pyspark.sql import functions as F

from playbill import SUITE, run_query
from playbill.operators import keep_top_groups, top_groups, top_keys, top_rows
from playbill.plans import suite
from playbill.schemas import CREDITS, EPISODES, GOLD, TITLES
from playbill.sources import register_views, write_layer
from tests.helpers import plan, rows


def _frame(spark, table, *records):
    """Rows of a mart from dicts; absent columns are NULL."""
    data = [tuple(r.get(c) for c in table.columns) for r in records]
    return spark.createDataFrame(data, table.ddl)


def _episodes(spark, *specs):
    """(series key, series title, season, own rating, series rating, series votes)."""
    return _frame(spark, EPISODES, *[
        dict(tconst=f"e{i}", parentTconst=key, seriesTitle=title, seasonNumber=season,
             episodeAverageRating=own, seriesAverageRating=series, seriesNumVotes=votes,
             start_decade="1990")
        for i, (key, title, season, own, series, votes) in enumerate(specs)])


def test_top_movies_filters_sorts_and_settles_ties(spark):
    movie = dict(titleType="movie", start_decade="1990")
    df = _frame(
        spark, TITLES,
        *[dict(movie, tconst=f"t{i}", primaryTitle=f"T{i}", averageRating=8.0, numVotes=20_000)
          for i in (3, 1, 2)],
        dict(movie, tconst="a", primaryTitle="few", averageRating=9.9, numVotes=9_999),
        dict(movie, tconst="b", primaryTitle="enough", averageRating=9.0, numVotes=10_000),
        dict(movie, tconst="c", primaryTitle="unrated"),
        dict(movie, tconst="d", primaryTitle="more", averageRating=9.0, numVotes=10_001),
        dict(tconst="e", titleType="short", averageRating=10.0, numVotes=99_999))
    got = [r["primaryTitle"] for r in suite.top_movies(df, k=4).collect()]
    assert got == ["more", "enough", "T1", "T2"]
    short = suite.top_movies(df, title_type="short", min_votes=1).collect()
    assert [r["averageRating"] for r in short] == [10.0]


def test_season_episodes_counts_null_seasons_and_merges_homonyms(spark):
    df = _episodes(
        spark, ("s1", "Show", 1, None, None, 50), ("s1", "Show", None, None, None, 50),
        ("s2", "Show", 1, None, None, 40), ("s3", "Low", 1, None, None, 1),
        ("s4", "None", 1, None, None, None))
    got = [tuple(r) for r in suite.season_episodes(df, k=2).collect()]
    assert got == [("Show", None, 1), ("Show", 1, 2)]
    assert [r[0] for r in suite.season_episodes(df, k=4).collect()][0] == "Low"


def test_genre_decade_rating_skips_null_and_sorts_both_ways(spark):
    df = _frame(spark, TITLES, *[
        dict(tconst=str(i), titleType="movie", primary_genre=g, averageRating=r, start_decade=d)
        for i, (g, r, d) in enumerate([
            ("War", 5.0, "1990"), ("War", 6.0, "1990"), ("Drama", 7.0, "1990"),
            ("War", None, "1990"), (None, 9.0, "1990"), ("War", 1.0, "1980")])])
    assert [tuple(r) for r in suite.genre_decade_rating(df).collect()] == [
        ("War", "1980", 1.0, 1), ("Drama", "1990", 7.0, 1), ("War", "1990", 5.5, 2)]


def test_rating_gap_groups_by_title_and_needs_ten_episodes(spark):
    homonyms = [("s1", "Twin", 1, 8.0, 6.0, 1)] * 5 + [("s2", "Twin", 1, 6.0, 6.0, 1)] * 5
    small = [("s3", "Small", 1, 9.0, 1.0, 1)] * 9 + [("s3", "Small", 1, None, 1.0, 1)]
    other = [("s4", "Even", 1, 5.0, 5.5, 1)] * 10
    got = suite.rating_gap(_episodes(spark, *homonyms, *small, *other))
    assert got.columns == ["seriesTitle", "avg_episode_rating", "avg_series_rating", "rating_gap"]
    assert [tuple(r) for r in got.collect()] == [
        ("Twin", 7.0, 6.0, 1.0), ("Even", 5.0, 5.5, -0.5)]


def test_top_credited_counts_names_not_people(spark):
    df = _frame(spark, CREDITS, *[
        dict(tconst="t", nconst=n, primaryName=p, category=c)
        for n, p, c in [("n1", "Ann", "actor"), ("n2", "Ann", "actress"), ("n3", "Bob", "actor"),
                        ("n4", "Cy", "actor"), ("n5", "Dee", "director")]])
    assert [tuple(r) for r in suite.top_credited(df, k=2).collect()] == [("Ann", 2), ("Bob", 1)]
    assert rows(suite.top_credited(df, categories=["director"])) == [("Dee", 1)]


def test_runtime_by_type_decade(spark):
    df = _frame(spark, TITLES, *[
        dict(tconst=str(i), titleType=t, runtimeMinutes=m, start_decade="1990")
        for i, (t, m) in enumerate([("movie", 90), ("movie", 91), ("short", 5), ("short", None)])])
    assert [tuple(r) for r in suite.runtime_by_type_decade(df).collect()] == [
        ("movie", "1990", 90.5, 2), ("short", "1990", 5.0, 1)]


@pytest.mark.parametrize("k", [1, 3, 10, 40, 60, 200])
def test_top_keys_equal_a_full_ranking(spark, k):
    """Scores with many ties, NULLs and one hot key; 61 keys, a third unscored."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 60)).alias("k"),
        F.when(F.col("id") % 60 < 40, F.col("id") % 60 % 7).alias("n"))
    best = df.groupBy("k").agg(F.max("n").alias("n")).collect()
    ranked = sorted(best, key=lambda r: (r["n"] is None, -(r["n"] or 0), r["k"]))
    got = [r["k"] for r in top_keys(df, "k", "n", k).collect()]
    assert got == [r["k"] for r in ranked[:k]]


def test_hidden_key_top_groups_scan_twice(spark, gold):
    got = plan(run_query(spark, "q2_season_episodes"))
    assert got.count("FileScan") == 2 and "Subquery" not in got
    assert "TakeOrderedAndProject" in got


def test_null_tests_are_pushed_to_the_scan(spark, gold):
    for name, columns in (
            ("q3_genre_decade_rating", ("primary_genre", "averageRating")),
            ("q4_rating_gap", ("episodeAverageRating", "seriesAverageRating")),
            ("q6_runtime_by_type_decade", ("runtimeMinutes",))):
        pushed = plan(run_query(spark, name)).split("PushedFilters")[1].split("]")[0]
        assert all(f"IsNotNull({c})" in pushed for c in columns)


def test_nan_is_a_value(spark):
    nan = float("nan")
    df = _frame(spark, TITLES, *[
        dict(tconst=str(i), titleType="movie", primary_genre="War", averageRating=r,
             start_decade="1990") for i, r in enumerate([nan, 8.0, None])])
    (row,) = suite.genre_decade_rating(df).collect()
    assert row["avg_rating"] != row["avg_rating"] and row["title_count"] == 2
    gaps = suite.rating_gap(_episodes(spark, *[("s", "S", 1, nan, 5.0, 1)] * 10)).collect()
    assert len(gaps) == 1 and gaps[0]["avg_series_rating"] == 5.0


def test_generic_top_k(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 5), ("c", None), (None, 9)],
                               "k string, n int")
    assert [r[0] for r in top_rows(df, [F.desc("n"), F.asc("k")], 3).collect()] == [
        None, "a", "b"]
    assert [r[0] for r in top_keys(df, "k", "n", 3).collect()] == [None, "a", "b"]
    # a NULL key takes a place but matches no row
    assert rows(keep_top_groups(df, "k", "n", 2)) == [("a", 1), ("a", 5)]
    kept = top_groups(df, ["k"], [F.sum("n").alias("s")], [F.desc("s")], min_count=2)
    assert rows(kept) == [("a", 6)]


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    titles = _frame(spark, TITLES, *[
        dict(tconst=f"t{i}", primaryTitle=f"T{i % 7}", titleType=["movie", "short"][i % 2],
             runtimeMinutes=i % 50 or None, primary_genre=["War", None, "Drama"][i % 3],
             averageRating=(i % 37 + 4) / 4 if i % 5 else None, numVotes=i * 300 if i % 5 else None,
             start_decade=str(1950 + i % 4 * 10)) for i in range(300)])
    episodes = _episodes(spark, *[
        (f"s{i % 30}", f"S{i % 20}", i % 4 or None, (i % 37 + 4) / 4, (i % 30 + 4) / 4, i % 30)
        for i in range(600)])
    credits = _frame(spark, CREDITS, *[
        dict(tconst=f"t{i % 300}", nconst=f"n{i % 40}", primaryName=f"P{i % 33}",
             category=["actor", "actress", "writer"][i % 3]) for i in range(900)])
    for table, df in zip(GOLD, (titles, episodes, credits)):
        write_layer(df, f"{root}/{table.name}", table.partition_by, sort_by=table.sort_by)
    register_views(spark, root, GOLD)
    return root


def test_views_answer_any_sql(spark, gold):
    by_kind = spark.sql("""
        select titleType, is_rated is null as unflagged, sum(numVotes) as votes
        from titles_enriched where start_decade = '1950' group by all order by all""")
    assert [tuple(r) for r in by_kind.collect()] == [
        ("movie", True, sum(i * 300 for i in range(0, 300, 4) if i % 5))]
    joined = spark.sql("""
        select count(*) from cast_credits join titles_enriched using (tconst)""")
    assert joined.first()[0] == 900


def test_all_named_queries_run_over_views(spark, gold):
    for name in SUITE:
        assert run_query(spark, name).count() > 0


def test_named_queries_take_parameters(spark, gold):
    assert run_query(spark, "q5_top_credited", k=3).count() == 3


def test_partitions_and_row_groups_are_pruned(spark, gold):
    movies = plan(run_query(spark, "q1_top_movies"))
    assert "(titleType" in movies.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(numVotes,10000)" in movies
    assert "TakeOrderedAndProject" in movies
    people = plan(run_query(spark, "q5_top_credited"))
    assert "IN (actor,actress)" in people.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<primaryName:string>" in people
