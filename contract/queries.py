"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Most read the stand-in catalogue: raw text, Silver or Gold, built by the
library's own jobs from the whole given tables. Arrays are returned as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import standin
from playbill import SUITE, corrupt_counts, publish_gold, run_query, workspace
from playbill import functions as fn
from playbill import operators as op
from playbill import schemas as S
from playbill.plans.layers import CLEANERS, read_raw
from playbill.sources import (
    null_counts, partition_files, read_layer, register_views, write_layer,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def _register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def _raw(spark: SparkSession, sf_dir: str, table: S.Table) -> DataFrame:
    return read_raw(spark, standin.lake(spark, sf_dir).with_raw(table), table)


def _cleaned(spark: SparkSession, sf_dir: str, table: S.Table) -> DataFrame:
    """A Silver table straight from raw text."""
    raw, clean = next((r, c) for r, silver, c in CLEANERS if silver is table)
    return clean(_raw(spark, sf_dir, raw))


def _silver(spark: SparkSession, sf_dir: str, table: S.Table) -> DataFrame:
    return read_layer(spark, standin.lake(spark, sf_dir).with_silver(table), table)


def _gold(spark: SparkSession, sf_dir: str, table: S.Table) -> DataFrame:
    return read_layer(spark, standin.lake(spark, sf_dir).with_gold(table), table)


def _native(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flat(df: DataFrame) -> DataFrame:
    """The genre array as text."""
    return df.withColumn("genres_array", F.array_join("genres_array", ","))


# ---- sources ----------------------------------------------------------------

@_register
def scan_delimited(spark, sf_dir):
    return _raw(spark, sf_dir, S.RAW_TITLES)


@_register
def null_token_counts(spark, sf_dir):
    return null_counts(_raw(spark, sf_dir, S.RAW_TITLES))


@_register
def scan_typed_ratings(spark, sf_dir):
    return _raw(spark, sf_dir, S.RAW_RATINGS)


@_register
def layer_roundtrip(spark, sf_dir):
    root = workspace(spark)
    episodes = _cleaned(spark, sf_dir, S.SILVER_EPISODES)
    write_layer(episodes, f"{root}/{S.SILVER_EPISODES.name}")
    return read_layer(spark, root, S.SILVER_EPISODES)


@_register
def partitioned_roundtrip(spark, sf_dir):
    root = workspace(spark)
    titles = _cleaned(spark, sf_dir, S.SILVER_TITLES)
    write_layer(titles, f"{root}/{S.SILVER_TITLES.name}", S.SILVER_TITLES.partition_by)
    return _flat(read_layer(spark, root, S.SILVER_TITLES))


@_register
def partition_columns_from_path(spark, sf_dir):
    """Partition columns exist only in the directory names."""
    titles = _gold(spark, sf_dir, S.TITLES)
    return titles.groupBy("titleType", "start_decade").agg(
        F.count("*").alias("title_count"))


@_register
def partition_file_stats(spark, sf_dir):
    files = partition_files(
        _silver(spark, sf_dir, S.SILVER_CREDITS), S.SILVER_CREDITS.partition_by)
    # a value is in one file unless it is large
    return files.select(
        "category", "row_count",
        F.expr("file_count <= 1 + byte_count div 1000000").alias("gathered"))


# ---- cleaners and column expressions ----------------------------------------

@_register
def clean_titles(spark, sf_dir):
    return _flat(_cleaned(spark, sf_dir, S.SILVER_TITLES))


@_register
def clean_ratings(spark, sf_dir):
    return _cleaned(spark, sf_dir, S.SILVER_RATINGS)


@_register
def clean_episodes(spark, sf_dir):
    return _cleaned(spark, sf_dir, S.SILVER_EPISODES)


@_register
def clean_credits(spark, sf_dir):
    return _cleaned(spark, sf_dir, S.SILVER_CREDITS)


@_register
def clean_people(spark, sf_dir):
    return _cleaned(spark, sf_dir, S.SILVER_PEOPLE)


@_register
def decade_bucket(spark, sf_dir):
    titles = _raw(spark, sf_dir, S.RAW_TITLES)
    return titles.select(
        "tconst", fn.decade(fn.to_int("startYear")).alias("start_decade"))


@_register
def split_list(spark, sf_dir):
    genres = fn.split_list("genres")
    return _raw(spark, sf_dir, S.RAW_TITLES).select(
        "tconst", F.size(genres).alias("genre_count"),
        F.array_join(genres, "|").alias("genre_list"))


@_register
def primary_of_list(spark, sf_dir):
    return _raw(spark, sf_dir, S.RAW_TITLES).select(
        "tconst", fn.first_of(fn.split_list("genres")).alias("primary_genre"))


# ---- joins and marts --------------------------------------------------------

@_register
def rated_flag(spark, sf_dir):
    return _gold(spark, sf_dir, S.TITLES).groupBy("titleType", "is_rated").agg(
        F.count("*").alias("title_count"))


@_register
def enrich_titles(spark, sf_dir):
    return _flat(op.enrich_titles(
        _silver(spark, sf_dir, S.SILVER_TITLES), _silver(spark, sf_dir, S.SILVER_RATINGS)))


@_register
def enrich_episodes(spark, sf_dir):
    return op.enrich_episodes(
        _silver(spark, sf_dir, S.SILVER_EPISODES), _gold(spark, sf_dir, S.TITLES))


@_register
def enrich_credits(spark, sf_dir):
    return op.enrich_credits(
        _silver(spark, sf_dir, S.SILVER_CREDITS), _gold(spark, sf_dir, S.TITLES),
        _silver(spark, sf_dir, S.SILVER_PEOPLE))


@_register
def inner_lookup(spark, sf_dir):
    credits = _silver(spark, sf_dir, S.SILVER_CREDITS).select("tconst", "nconst", "category")
    people = _silver(spark, sf_dir, S.SILVER_PEOPLE)
    return op.with_role(credits, people, "nconst", "nconst", {"primaryName": "person"})


@_register
def orphan_credits(spark, sf_dir):
    return op.orphans(
        _silver(spark, sf_dir, S.SILVER_CREDITS), _silver(spark, sf_dir, S.SILVER_PEOPLE),
        "nconst")


@_register
def episode_decade(spark, sf_dir):
    return _gold(spark, sf_dir, S.EPISODES).select(
        "tconst", op.episode_decade().alias("start_decade"))


@_register
def decade_with_parent_fallback(spark, sf_dir):
    return op.enrich_episodes(
        _silver(spark, sf_dir, S.SILVER_EPISODES), _gold(spark, sf_dir, S.TITLES),
        parent_fallback=True,
    ).select("tconst", "parentTconst", "start_decade")


@_register
def first_known_year(spark, sf_dir):
    """Chain of fallbacks over text: the episode's year, the series' year, unknown."""
    return _gold(spark, sf_dir, S.EPISODES).select("tconst", fn.first_known(
        F.col("episodeStartYear").cast("string"), F.col("seriesStartYear").cast("string"),
    ).alias("known_year"))


@_register
def enrich_documents(spark, sf_dir):
    """Optional enrichment on given tables: documents with their labels."""
    documents = _native(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return op.enrich(
        documents, _native(spark, sf_dir, "labels"), "doc_id", ("is_labelled", "quality"))


@_register
def nation_roles(spark, sf_dir):
    """Role-playing dimension on given tables: customer and supplier nation."""
    nation = _native(spark, sf_dir, "nation")
    lines = _native(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return (
        lines
        .transform(op.with_role, _native(spark, sf_dir, "supplier"),
                   "l_suppkey", "s_suppkey", {"s_nationkey": "s_nationkey"})
        .transform(op.with_role, _native(spark, sf_dir, "orders"),
                   "l_orderkey", "o_orderkey", {"o_custkey": "o_custkey"})
        .transform(op.with_role, _native(spark, sf_dir, "customer"),
                   "o_custkey", "c_custkey", {"c_nationkey": "c_nationkey"})
        .groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("line_count"))
        .transform(op.with_role, nation, "c_nationkey", "n_nationkey",
                   {"n_name": "customer_nation"})
        .transform(op.with_role, nation, "s_nationkey", "n_nationkey",
                   {"n_name": "supplier_nation"})
        .select("customer_nation", "supplier_nation", "line_count")
    )


# ---- predicates, aggregates, top-k ------------------------------------------

@_register
def filter_partition_eq(spark, sf_dir):
    return _gold(spark, sf_dir, S.TITLES).where(
        F.col("titleType") == "movie").select("tconst", "primaryTitle", "start_decade")


@_register
def filter_votes_at_least(spark, sf_dir):
    return _gold(spark, sf_dir, S.TITLES).where(
        F.col("numVotes") >= 10_000).select("tconst", "numVotes")


@_register
def filter_in(spark, sf_dir):
    return _gold(spark, sf_dir, S.CREDITS).where(
        F.col("category").isin("actor", "actress")).select("tconst", "nconst", "category")


@_register
def filter_not_null(spark, sf_dir):
    return _gold(spark, sf_dir, S.TITLES).where(
        F.col("primary_genre").isNotNull() & F.col("averageRating").isNotNull()
    ).select("tconst", "primary_genre", "averageRating")


@_register
def count_by_key(spark, sf_dir):
    return _gold(spark, sf_dir, S.CREDITS).groupBy("nconst").agg(
        F.count("*").alias("credit_count"))


@_register
def count_null_group(spark, sf_dir):
    """Composite keys; a NULL season is a group of its own."""
    return _gold(spark, sf_dir, S.EPISODES).groupBy("seriesTitle", "seasonNumber").agg(
        F.count("*").alias("episode_count"))


@_register
def average_by_key(spark, sf_dir):
    """Averages of a double and of an int; NULLs are ignored."""
    return _gold(spark, sf_dir, S.TITLES).groupBy("titleType").agg(
        F.avg("averageRating").alias("avg_rating"),
        F.avg("runtimeMinutes").alias("avg_runtime_minutes"))


@_register
def max_by_key(spark, sf_dir):
    return _gold(spark, sf_dir, S.EPISODES).groupBy("parentTconst").agg(
        F.max("seriesNumVotes").alias("max_votes"))


@_register
def aggregate_gap(spark, sf_dir):
    return _gold(spark, sf_dir, S.EPISODES).groupBy("seriesTitle").agg(
        (F.avg("episodeAverageRating") - F.avg("seriesAverageRating")).alias("rating_gap"))


@_register
def having_min_count(spark, sf_dir):
    return op.top_groups(
        _gold(spark, sf_dir, S.CREDITS), ["nconst", "category"],
        [F.max("numVotes").alias("max_votes")], [F.asc("nconst"), F.asc("category")],
        min_count=10)


@_register
def sort_mixed(spark, sf_dir):
    return op.top_groups(
        _gold(spark, sf_dir, S.TITLES), ["start_decade", "titleType"],
        [F.count("*").alias("title_count")], [F.asc("start_decade"), F.desc("titleType")])


@_register
def topk_rows(spark, sf_dir):
    order = [F.desc_nulls_last("numVotes"), F.asc("tconst")]
    return op.top_rows(_gold(spark, sf_dir, S.TITLES), order, 50).select("tconst", "numVotes")


@_register
def topk_groups(spark, sf_dir):
    return op.top_groups(
        _gold(spark, sf_dir, S.CREDITS), ["primaryName"],
        [F.count("*").alias("credit_count")],
        [F.desc("credit_count"), F.asc("primaryName")], 15)


@_register
def topk_hidden_key(spark, sf_dir):
    return op.top_keys(
        _gold(spark, sf_dir, S.EPISODES), "parentTconst", "seriesNumVotes", 10)


@_register
def topk_semi_join(spark, sf_dir):
    return op.keep_top_groups(
        _gold(spark, sf_dir, S.EPISODES), "parentTconst", "seriesNumVotes", 10
    ).select("tconst", "parentTconst", "seasonNumber", "episodeNumber")


# ---- publishing and audits --------------------------------------------------

def _database() -> str:
    return f"playbill_{uuid.uuid4().hex[:12]}"


@_register
def publish_bucketed(spark, sf_dir):
    """Rows of a mart read back from its published, bucketed table."""
    database, location = _database(), f"{workspace(spark)}/tables"
    op.ensure_database(spark, database, location)
    op.publish(_gold(spark, sf_dir, S.CREDITS), S.CREDITS, database)
    return spark.table(f"{database}.{S.CREDITS.name}")


@_register
def publish_rejects(spark, sf_dir):
    """Rows of a mart that break its limits, as they lie in the quarantine table."""
    database, location = _database(), f"{workspace(spark)}/tables"
    op.ensure_database(spark, database, location)
    op.publish(_gold(spark, sf_dir, S.CREDITS), S.CREDITS, database)
    return spark.table(f"{database}.{S.CREDITS.name}_rejected")


@_register
def publish_audit(spark, sf_dir):
    gold = standin.lake(spark, sf_dir).with_gold(*S.GOLD)
    return publish_gold(spark, gold, _database(), f"{workspace(spark)}/tables")


def _narrow_titles() -> S.Table:
    """The titles mart under tighter rules, which some rows break."""
    tighter = {
        "primaryTitle": {"limit": 8}, "startYear": {"required": True},
        "genres_array": {"limit": 9},
    }
    fields = tuple(replace(f, **tighter.get(f.name, {})) for f in S.TITLES.fields)
    return replace(S.TITLES, fields=fields)


@_register
def conform_schema(spark, sf_dir):
    good, _ = op.conform(_gold(spark, sf_dir, S.TITLES), _narrow_titles())
    return _flat(good)


@_register
def conform_rejects(spark, sf_dir):
    _, rejected = op.conform(_gold(spark, sf_dir, S.TITLES), _narrow_titles())
    return rejected.select("tconst", "primaryTitle", "startYear", "reject_reason")


@_register
def completeness_audit(spark, sf_dir):
    """The five required raw files, and one that is not taken."""
    manifest = [*(t.name for t in S.BRONZE), "title.akas.tsv"]
    return op.completeness(
        spark, manifest, {t.name: _raw(spark, sf_dir, t) for t in S.BRONZE})


@_register
def corrupt_row_counts(spark, sf_dir):
    return corrupt_counts(spark, standin.lake(spark, sf_dir).with_raw(*S.BRONZE))


@_register
def layer_row_counts(spark, sf_dir):
    return op.audit_counts({t.name: _raw(spark, sf_dir, t) for t in S.BRONZE})


@_register
def silver_row_counts(spark, sf_dir):
    return op.audit_counts({t.name: _silver(spark, sf_dir, t) for t in S.SILVER})


@_register
def gold_row_counts(spark, sf_dir):
    return op.audit_counts({t.name: _gold(spark, sf_dir, t) for t in S.GOLD})


# ---- the named queries ------------------------------------------------------

def _named(name: str) -> Query:
    def query(spark, sf_dir):
        mart = next(t for t in S.GOLD if t.name == SUITE[name][0])
        register_views(spark, standin.lake(spark, sf_dir).with_gold(mart), [mart])
        return run_query(spark, name)
    return query


REGISTRY.update({name: _named(name) for name in SUITE})
