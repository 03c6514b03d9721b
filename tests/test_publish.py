from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from playbill.operators import (
    audit_counts, completeness, conform, ensure_database, publish,
)
from playbill.schemas import CREDITS, Field, Table
from tests.helpers import plan, rows, same_rows

PEOPLE = Table("people", (
    Field("id", limit=4, required=True), Field("age", "int"),
    Field("tags", "array<string>", limit=3)), bucket_by="id", buckets=4)


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}"
    ensure_database(spark, name, f"{tmp_path}/tables")
    ensure_database(spark, name, f"{tmp_path}/tables")
    yield name
    spark.sql(f"drop database {name} cascade")


def _people(spark):
    return spark.createDataFrame([
        (["ok"], "1", "a", "extra"), (["abcd"], "2", "b", "extra"), (None, "old", "c", "extra"),
        ([], None, None, "extra"), (["abcd"], "x", "toolong", "extra"), ([None], "5", "abcd", "")],
        "tags array<string>, age string, id string, other string")


def test_conform_orders_types_and_splits(spark):
    good, rejected = conform(_people(spark), PEOPLE)
    assert good.dtypes == [("id", "string"), ("age", "int"), ("tags", "array<string>")]
    assert rows(good) == [("a", 1, ["ok"]), ("abcd", 5, [None])]
    assert rows(rejected, "id", "age", "reject_reason") == [
        ("b", "2", "tags: longer than 3"), ("c", "old", "age: not int"),
        ("toolong", "x", "id: longer than 4; age: not int; tags: longer than 3"),
        (None, None, "id: null")]
    assert good.count() + rejected.count() == _people(spark).count()


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="people: missing columns age, tags"):
        conform(spark.createDataFrame([("a",)], "id string"), PEOPLE)


def test_limits_count_bytes(spark):
    df = spark.createDataFrame(
        [("éé", None, ["é"]), ("ééa", None, None), ("a", None, ["éé"])],
        "id string, age int, tags array<string>")
    good, rejected = conform(df, PEOPLE)
    assert rows(good, "id") == [("éé",)]
    assert rows(rejected, "reject_reason") == [("id: longer than 4",), ("tags: longer than 3",)]


def test_publish_audits_and_quarantines(spark, database):
    audit = publish(_people(spark), PEOPLE, database)
    assert rows(audit) == [("people", 6, 2, 4, True)]
    assert rows(spark.table(f"{database}.people"), "id") == [("a",), ("abcd",)]
    assert spark.table(f"{database}.people_rejected").count() == 4


def test_overwrite_is_repeatable_and_append_adds(spark, database):
    df = _people(spark)
    for mode, expected in (("append", 2), ("overwrite", 2), ("overwrite", 2), ("append", 4)):
        audit = publish(df, PEOPLE, database, mode)
        assert rows(audit) == [("people", 6, 2, 4, True)]
        assert spark.table(f"{database}.people").count() == expected
    assert spark.table(f"{database}.people_rejected").count() == 8
    with pytest.raises(ValueError, match="upsert"):
        publish(df, PEOPLE, database, "upsert")


def _numbered(spark, n=2000, hot=0):
    key = F.when(F.col("id") < hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(n).select(key.alias("key"), F.col("id").alias("value"))


NUMBERED = Table("numbered", (Field("key"), Field("value", "bigint")), bucket_by="key", buckets=4)


def test_bucketed_tables_group_and_join_without_shuffle(spark, database, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    publish(_numbered(spark), NUMBERED, database)
    publish(_numbered(spark), replace(NUMBERED, name="other"), database)
    a, b = (spark.table(f"{database}.{t}") for t in ("numbered", "other"))
    assert same_rows(a, _numbered(spark))
    grouped = a.groupBy("key").count()
    assert "Exchange" not in plan(grouped) and grouped.count() == 500
    assert "Exchange" not in plan(a.join(b, "key"))


def _described(spark, table):
    return {r["col_name"]: r["data_type"]
            for r in spark.sql(f"describe formatted {table}").collect()}


def test_buckets_are_declared_by_the_caller(spark, database):
    df = _numbered(spark)
    publish(df, NUMBERED, database, buckets=20)
    described = _described(spark, f"{database}.numbered")
    assert described["Num Buckets"] == "20"
    assert described["Bucket Columns"] == "[`key`]" and described["Sort Columns"] == "[`key`]"
    publish(df, NUMBERED, database)
    assert _described(spark, f"{database}.numbered")["Num Buckets"] == "4"
    ordered = replace(NUMBERED, publish_order=("key", "value"))
    publish(df, ordered, database)
    assert _described(spark, f"{database}.numbered")["Sort Columns"] == "[`key`, `value`]"


def test_append_follows_the_table_as_it_is(spark, database):
    df = _numbered(spark)
    publish(df, NUMBERED, database, buckets=2)
    audit = publish(df, NUMBERED, database, "append", buckets=101)
    assert rows(audit) == [("numbered", 2000, 2000, 0, True)]
    table = spark.table(f"{database}.numbered")
    assert _described(spark, f"{database}.numbered")["Num Buckets"] == "2"
    per_bucket = table.select("_metadata.file_path", (F.pmod(F.hash("key"), F.lit(2))).alias("b")).distinct()
    assert per_bucket.count() == per_bucket.select("file_path").distinct().count()
    assert same_rows(table, df.unionAll(df))


def test_a_sorted_layout_is_not_declared_bucketed(spark, database):
    df = _numbered(spark, hot=700)
    audit = publish(df, NUMBERED, database, layout="sorted")
    assert rows(audit) == [("numbered", 2000, 2000, 0, True)]
    assert "Num Buckets" not in _described(spark, f"{database}.numbered")
    assert same_rows(spark.table(f"{database}.numbered"), df)
    assert rows(publish(df, NUMBERED, database, "append")) == [("numbered", 2000, 2000, 0, True)]
    with pytest.raises(ValueError, match="heap"):
        publish(df, NUMBERED, database, layout="heap")


def test_more_buckets_than_rows_need_are_no_fault(spark, database):
    df = _numbered(spark, n=300)
    assert rows(publish(df, NUMBERED, database, buckets=1000)) == [("numbered", 300, 300, 0, True)]


def test_a_hot_bucket_is_written_by_several_tasks(spark, database, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "4k")
    df = _numbered(spark, n=40_000, hot=30_000).repartition(8).checkpoint()
    publish(df, NUMBERED, database)
    table = spark.table(f"{database}.numbered")
    hot_files = table.where("key = 'hot'").select("_metadata.file_path").distinct().count()
    assert hot_files > 1
    assert _described(spark, f"{database}.numbered")["Num Buckets"] == "4"
    assert same_rows(table, df)


def test_publishing_a_declared_mart(spark, database):
    one = spark.createDataFrame(
        [("t1", "n1", "c", "Ann", "movie", "T", 1990, "1990", "War", 8.0, 5, "actor"),
         ("t" * 21, "n1", "c", "Ann", "movie", "T", 1990, "1990", "War", 8.0, 5, "actor"),
         ("t3", None, "c", "Ann", "movie", "T", 1990, "1990", "War", 8.0, 5, None)], CREDITS.ddl)
    assert rows(publish(one, CREDITS, database)) == [("cast_credits", 3, 1, 2, True)]
    assert rows(spark.table(f"{database}.cast_credits_rejected"), "reject_reason") == [
        ("nconst: null; category: null",), ("tconst: longer than 20",)]


def test_audit_counts_and_completeness(spark):
    some, none = spark.range(5), spark.range(0)
    assert rows(audit_counts({"some": some, "none": none})) == [("none", 0), ("some", 5)]
    audit = completeness(spark, ["some", "none", "absent"], {"some": some, "none": none})
    assert rows(audit) == [("absent", 0, False), ("none", 0, False), ("some", 5, True)]
    assert rows(completeness(spark, ["a"], {})) == [("a", 0, False)]
