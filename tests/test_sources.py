import pytest
from pyspark.sql import functions as F

from playbill import session
from playbill.schemas import Field, Table
from playbill.sources import (
    null_counts, partition_files, read_delimited, read_layer, register_views,
    write_delimited, write_layer,
)
from tests.helpers import rows, same_rows, write_text

TITLE = "title string, year int"


def test_header_skipped_and_null_token_read(spark, tmp_path):
    path = write_text(tmp_path / "a.tsv", "title\tyear", "Alpha\t1991", "\\N\t\\N")
    df = read_delimited(spark, path, TITLE)
    assert df.schema.simpleString() == "struct<title:string,year:int>"
    assert rows(df) == [("Alpha", 1991), (None, None)]


def test_other_separator_and_null_token(spark, tmp_path):
    path = write_text(tmp_path / "a.csv", "title,year", "Alpha,NA")
    assert rows(read_delimited(spark, path, TITLE, null_token="NA", sep=",")) == [("Alpha", None)]


def test_stray_quote_is_kept_by_default(spark, tmp_path):
    path = write_text(tmp_path / "a.tsv", "title\tyear", '"Open\t1991', '"Full"\t1992', "B\t1993")
    assert rows(read_delimited(spark, path, TITLE)) == [
        ('"Full"', 1992), ('"Open', 1991), ("B", 1993)]


def test_stray_quote_swallows_the_line_in_quoted_mode(spark, tmp_path):
    path = write_text(tmp_path / "a.tsv", "title\tyear", '"Open\t1991', '"Full"\t1992', "B\t1993")
    got = rows(read_delimited(spark, path, TITLE, quote='"'))
    assert ("Full", 1992) in got and ("B", 1993) in got
    assert [r for r in got if "Open" in (r[0] or "")][0][1] is None


def test_unreadable_typed_cells_become_null(spark, tmp_path):
    path = write_text(tmp_path / "r.tsv", "tconst\taverageRating\tnumVotes",
                      "t1\t7.5\t10", "t2\thigh\t20", "t3\t8.0\tmany")
    df = read_delimited(spark, path, "tconst string, averageRating double, numVotes bigint")
    assert rows(df) == [("t1", 7.5, 10), ("t2", None, 20), ("t3", 8.0, None)]


def test_ragged_rows_are_padded_or_cut(spark, tmp_path):
    path = write_text(tmp_path / "a.tsv", "title\tyear\tnote", "Short\t1991", "Long\t1992\tx\textra")
    df = read_delimited(spark, path, "title string, year int, note string")
    assert rows(df) == [("Long", 1992, "x"), ("Short", 1991, None)]


def test_corrupt_column_keeps_the_raw_line(spark, tmp_path):
    path = write_text(tmp_path / "a.tsv", "title\tyear", "Good\t1991", "Bad\tsoon", "Short")
    df = read_delimited(spark, path, TITLE, corrupt_column="_raw")
    assert rows(df) == [
        ("Bad", None, "Bad\tsoon"), ("Good", 1991, None), ("Short", None, "Short")]


def test_swapped_header_binds_by_position_unless_strict(spark, tmp_path):
    path = write_text(tmp_path / "a.tsv", "id\ttitle", "1\tAlpha")
    schema = "title string, id string"
    assert rows(read_delimited(spark, path, schema)) == [("1", "Alpha")]
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, path, schema, strict_header=True).collect()
    matching = read_delimited(spark, path, "id string, title string", strict_header=True)
    assert rows(matching) == [("1", "Alpha")]


def test_text_round_trip_with_awkward_values(spark, tmp_path):
    df = spark.createDataFrame(
        [('["P1"]', " padded "), (None, '"quoted"'), ("back\\slash", "ünïcode"), ("a,b", "x")],
        "a string, b string").repartition(3)
    write_delimited(df, f"{tmp_path}/t.tsv")
    assert same_rows(read_delimited(spark, f"{tmp_path}/t.tsv", "a string, b string"), df)


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(null_counts(df)) == [("a", 1), ("b", 2)]


DECADES = Table("t", (Field("id", "int"), Field("kind"), Field("start_decade")),
                partition_by=("kind", "start_decade"))


def test_numeric_partition_values_stay_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "movie", "1990"), (2, "short", "2000")], DECADES.ddl)
    write_layer(df, f"{tmp_path}/t", DECADES.partition_by)
    assert dict(spark.read.parquet(f"{tmp_path}/t").dtypes)["start_decade"] == "int"
    back = read_layer(spark, str(tmp_path), DECADES)
    assert back.dtypes[-1] == ("start_decade", "string")
    assert back.where("start_decade = 'unknown'").count() == 0
    assert same_rows(back, df)


def test_null_and_empty_partition_values_read_back_null(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "1990"), (2, "", "1990"), (3, "a b/c", "unknown")],
                               DECADES.ddl)
    write_layer(df, f"{tmp_path}/t", DECADES.partition_by)
    assert rows(read_layer(spark, str(tmp_path), DECADES), "id", "kind") == [
        (1, None), (2, None), (3, "a b/c")]


def test_overwrite_replaces_and_append_adds(spark, tmp_path):
    plain = Table("t", DECADES.fields)
    df = spark.createDataFrame([(1, "a", "1990")], DECADES.ddl)
    for mode, expected in (("overwrite", 1), ("overwrite", 1), ("append", 2)):
        write_layer(df, f"{tmp_path}/t", mode=mode)
        assert read_layer(spark, str(tmp_path), plain).count() == expected


def test_one_file_for_small_values_and_many_for_a_large_one(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    df = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 20 == 0, "rare").otherwise("hot").alias("kind"),
        F.lit("1990").alias("start_decade"))
    write_layer(df, f"{tmp_path}/t", DECADES.partition_by, sort_by=["id"])
    stats = partition_files(read_layer(spark, str(tmp_path), DECADES), ["kind"])
    by_kind = {r["kind"]: r for r in stats.collect()}
    assert by_kind["hot"]["file_count"] > 3
    assert by_kind["hot"]["row_count"] == 57_000
    assert by_kind["rare"]["row_count"] == 3_000


def test_a_write_bounds_its_tasks_by_itself(spark, tmp_path, conf, monkeypatch):
    """However large the tasks are that the session asks for; its settings come back."""
    asked = {session.ADVISORY: "1g", session.SPLIT: "1g", session.PARTITIONS: "2"}
    for key, value in asked.items():
        conf(key, value)
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    monkeypatch.setattr(session, "SHUFFLED_SHARE", 64 << 10)
    monkeypatch.setattr(session, "STORED_SHARE", 16 << 10)
    spark.range(0, 60_000, numPartitions=8).write.parquet(f"{tmp_path}/given")
    df = spark.read.parquet(f"{tmp_path}/given").select(
        F.col("id").cast("int").alias("id"), F.lit("hot").alias("kind"), F.lit("1990").alias("start_decade"))
    with session.sized_for(df):
        with session.sized_for(df):
            pass
        assert int(spark.conf.get(session.PARTITIONS)) > 2
        assert spark.conf.get(session.ADVISORY) == f"{64 << 10}b"
        assert spark.conf.get(session.SPLIT) == f"{session.SCANNED_SHARE}b"
    write_layer(df, f"{tmp_path}/t", DECADES.partition_by, sort_by=["id"])
    got = read_layer(spark, str(tmp_path), DECADES)
    assert [r["file_count"] > 3 for r in partition_files(got, DECADES.partition_by).collect()] == [True]
    assert same_rows(got, df)
    assert {key: spark.conf.get(key) for key in asked} == asked


def test_bytes_of_all_files_that_a_frame_reads(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("a b%:"), F.col("id") % 3).alias("kind"))
    df.write.partitionBy("kind").parquet(f"{tmp_path}/a folder/t")
    df.write.parquet(f"{tmp_path}/a folder/other")
    stored = sum(p.stat().st_size for p in (tmp_path / "a folder" / "t").rglob("*.parquet"))
    assert session.read_bytes(spark.read.parquet(f"{tmp_path}/a folder/t")) == stored > 0
    assert session.read_bytes(spark.range(3)) == 0


def test_compressed_text_lies_in_files_of_bounded_rows(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=2).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 > 0, "a b").alias("title"))
    write_delimited(df, f"{tmp_path}/t", compression="lz4", max_rows=100)
    assert len(list((tmp_path / "t").glob("*.lz4"))) == 10
    assert same_rows(read_delimited(spark, f"{tmp_path}/t", "id string, title string"), df)


def test_small_partitions_get_one_file_each(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=8).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 5).cast("string").alias("kind"),
        F.lit("unknown").alias("start_decade"))
    write_layer(df, f"{tmp_path}/t", DECADES.partition_by)
    stats = partition_files(read_layer(spark, str(tmp_path), DECADES), DECADES.partition_by)
    assert {r["file_count"] for r in stats.collect()} == {1}
    assert {r["row_count"] for r in stats.collect()} == {200}


def test_files_are_snappy(spark, tmp_path):
    write_layer(spark.range(3), f"{tmp_path}/t")
    assert list((tmp_path / "t").glob("*.snappy.parquet"))


def test_views_answer_sql_and_prune_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "movie", "1990"), (2, "short", "unknown")], DECADES.ddl)
    write_layer(df, f"{tmp_path}/t", DECADES.partition_by)
    register_views(spark, str(tmp_path), [DECADES])
    assert rows(spark.sql("select id from t where start_decade = 'unknown'")) == [(2,)]
