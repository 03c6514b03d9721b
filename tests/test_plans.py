import pytest
from pyspark.sql import functions as F

from contract import standin
from playbill import (
    SUITE, corrupt_counts, publish_gold, run_all, run_gold, run_query, run_silver, workspace,
)
from playbill.operators import audit_counts, clean_episodes, conform
from playbill.plans.layers import read_raw
from playbill.schemas import (
    BRONZE, CREDITS, EPISODES, GOLD, RAW_CREDITS, RAW_EPISODES, RAW_PEOPLE, RAW_RATINGS,
    RAW_TITLES, SILVER, SILVER_EPISODES, TITLES,
)
from playbill.__main__ import main
from playbill.session import JOB_CONF, PARTITIONS, job_session, shuffle_partitions, stored_bytes
from playbill import session
from playbill.sources import partition_files, read_layer, register_views, write_layer
from tests.helpers import rows, same_rows, write_text

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    made = standin.lake(spark, SF_DIR)
    made.with_raw(*BRONZE)
    made.with_silver(*SILVER)
    made.with_gold(*GOLD)
    return made


def _counts(spark, root, tables):
    return rows(audit_counts({t.name: read_layer(spark, root, t) for t in tables}))


def test_whole_run_is_repeatable(spark, lake, tmp_path):
    silver, gold = f"{tmp_path}/silver", f"{tmp_path}/gold"
    for _ in range(2):
        run_all(spark, lake.bronze, silver, gold)
        assert _counts(spark, silver, SILVER) == _counts(spark, lake.silver, SILVER)
        assert _counts(spark, gold, GOLD) == _counts(spark, lake.gold, GOLD)


def test_raw_text_equals_its_source(spark, lake):
    made = standin.bronze_frames(standin.tables(spark, SF_DIR))
    for table in BRONZE:
        back = read_raw(spark, lake.bronze, table)
        expected = made[table.name].select(*[
            F.col(f.name).try_cast(f.type).alias(f.name) for f in table.fields])
        assert same_rows(back, expected)


def test_lines_of_open_orders_are_found_once(lake):
    frames = lake._frames(BRONZE)
    stored = set(frames[RAW_EPISODES.name].inputFiles())
    assert stored and all(f"{lake.root}/lines/" in f for f in stored)
    for table in standin.FROM_LINES:
        read = frames[table.name].inputFiles()
        assert stored <= set(read) and not any("lineitem" in f for f in read)


def test_silver_keeps_what_the_cleaner_gives(spark, lake):
    cleaned = clean_episodes(read_raw(spark, lake.bronze, RAW_EPISODES))
    assert same_rows(read_layer(spark, lake.silver, SILVER_EPISODES), cleaned)


def test_layers_are_partitioned_as_declared(spark, lake, tmp_path):
    from pathlib import Path
    for root, tables in ((lake.silver, SILVER), (lake.gold, GOLD)):
        for table in tables:
            found = {p.name.split("=")[0] for p in Path(root, table.name).rglob("*=*")
                     if p.is_dir()}
            assert found == set(table.partition_by)


def test_single_tables_and_marts_can_be_built(spark, lake, tmp_path):
    run_silver(spark, lake.bronze, f"{tmp_path}/silver", [SILVER_EPISODES])
    assert [p.name for p in (tmp_path / "silver").iterdir()] == ["title_episode"]
    run_gold(spark, lake.silver, f"{tmp_path}/gold", [TITLES])
    run_gold(spark, lake.silver, f"{tmp_path}/gold", [CREDITS])
    assert _counts(spark, f"{tmp_path}/gold", [TITLES, CREDITS]) == _counts(
        spark, lake.gold, [TITLES, CREDITS])
    assert not (tmp_path / "gold" / EPISODES.name).exists()


def test_each_value_of_a_partition_is_gathered(spark, lake, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    run_gold(spark, lake.silver, f"{tmp_path}/gold")
    got = read_layer(spark, f"{tmp_path}/gold", CREDITS)
    stats = partition_files(got, CREDITS.partition_by).collect()
    assert [r["file_count"] for r in stats] == [1, 1, 1]
    assert sum(r["row_count"] for r in stats) == got.count()


def test_job_options_reach_the_reader_and_the_marts(spark, tmp_path):
    bronze, silver, gold = (f"{tmp_path}/{x}" for x in ("bronze", "silver", "gold"))
    lines = {
        RAW_TITLES: ['t1\ttvSeries\t"Quoted"\to\t0\t1985\t\\N\t12.7\tWar',
                     't2\ttvEpisode\tEp\to\t0\t\\N\t\\N\tx\tWar'],
        RAW_RATINGS: ["t1\t8.0\t5", "t2\tbad\t5", "t3\t1.0"],
        RAW_EPISODES: ["t2\tt1\t1.5\t2"], RAW_CREDITS: ["t1\t1\tn1\tactor\t\\N\t\\N"],
        RAW_PEOPLE: ["n1\tAnn\t\\N\t\\N\t\\N\t\\N"],
    }
    (tmp_path / "bronze").mkdir()
    for table, text in lines.items():
        write_text(tmp_path / "bronze" / table.name, "\t".join(table.columns), *text)
    run_all(spark, bronze, silver, gold)
    titles = read_layer(spark, gold, TITLES)
    assert rows(titles, "primaryTitle", "runtimeMinutes") == [('"Quoted"', None), ("Ep", None)]
    assert rows(read_layer(spark, gold, EPISODES), "start_decade") == [("unknown",)]
    run_all(spark, bronze, silver, gold, truncate=True, parent_fallback=True, quote='"',
            strict_header=True)
    assert rows(read_layer(spark, gold, TITLES), "primaryTitle", "runtimeMinutes") == [
        ("Ep", None), ("Quoted", 12)]
    assert rows(read_layer(spark, gold, EPISODES), "seasonNumber", "start_decade") == [(1, "1980")]
    bad = {r["table_name"]: (r["row_count"], r["corrupt_count"])
           for r in corrupt_counts(spark, bronze).collect()}
    assert bad.pop(RAW_RATINGS.name) == (3, 2)
    assert set(bad.values()) == {(1, 0), (2, 0)}


def test_missing_raw_file_stops_before_any_write(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", tmp_path / "silver"
    bronze.mkdir()
    for table in BRONZE[:-1]:
        write_text(bronze / table.name, "\t".join(table.columns))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_silver(spark, str(bronze), str(silver))
    assert not silver.exists()


def test_publish_all_marts(spark, lake, tmp_path):
    audit = publish_gold(spark, lake.gold, "all_marts", f"{tmp_path}/tables")
    for row in audit.collect():
        assert row["balanced"] and row["rejected_rows"] > 0
        quarantine = spark.table(f"all_marts.{row['table_name']}_rejected")
        assert quarantine.count() == row["rejected_rows"]
    # the named queries give the same over published tables as over views of the same rows
    for mart in GOLD:
        spark.catalog.dropTempView(mart.name)
    spark.sql("use all_marts")
    published = {name: run_query(spark, name).collect() for name in SUITE}
    spark.sql("use default")
    for mart in GOLD:
        good, _ = conform(read_layer(spark, lake.gold, mart), mart)
        good.createOrReplaceTempView(mart.name)
    assert published == {name: run_query(spark, name).collect() for name in SUITE}
    register_views(spark, lake.gold, GOLD)
    spark.sql("drop database all_marts cascade")


def test_workspace_follows_the_session(spark, conf):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark).startswith(f"{shared}/")
    assert workspace(spark) != workspace(spark)


class _Session:
    def __init__(self, **settings):
        self.conf = settings


def test_workspace_lies_in_a_shared_folder():
    shared = _Session(**{"spark.master": "local[2]", "spark.sql.warehouse.dir": "/shared/tables"})
    assert workspace(shared).startswith("/shared/tables/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(_Session(**{"spark.master": "local[2]"}))


def test_shuffle_partitions():
    assert shuffle_partitions(1 << 20, cores=8) == 16
    assert shuffle_partitions(1 << 40, cores=8) == 8192
    assert shuffle_partitions(100 << 40, cores=8) == 819_200


def test_job_session_keeps_what_the_launcher_set(spark, conf):
    for key, value in JOB_CONF.items():
        conf(key, value)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    session = job_session("again")
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "128m"
    assert session.conf.get("spark.sql.shuffle.partitions") == "4"


def test_command_line(spark, lake, tmp_path, capsys, conf):
    for key, value in {**JOB_CONF, PARTITIONS: "4"}.items():
        conf(key, value)
    main(["etl", lake.bronze, f"{tmp_path}/silver", f"{tmp_path}/gold"])
    assert _counts(spark, f"{tmp_path}/gold", GOLD) == _counts(spark, lake.gold, GOLD)
    main(["publish", f"{tmp_path}/gold", "cli", "--location", f"{tmp_path}/tables",
          "--layout", "sorted"])
    assert "cast_credits" in capsys.readouterr().out
    main(["query", f"{tmp_path}/gold", "q5_top_credited", f"{tmp_path}/out"])
    got = spark.read.option("header", True).csv(f"{tmp_path}/out")
    assert got.columns == ["primaryName", "credit_count"]
    assert got.count() == run_query(spark, "q5_top_credited").count() > 0
    main(["suite", f"{tmp_path}/gold", f"{tmp_path}/all"])
    for name in SUITE:
        spark.read.option("header", True).csv(f"{tmp_path}/all/{name}").count()
    main(["corrupt", lake.bronze, f"{tmp_path}/corrupt"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/corrupt").count() == 5
    spark.sql("drop database cli cascade")


def test_a_query_writes_all_of_its_rows(spark, tmp_path, conf):
    for key, value in {**JOB_CONF, PARTITIONS: "4"}.items():
        conf(key, value)
    titles = spark.range(300).selectExpr(
        "concat('t', id) as tconst", "'movie' as titleType", "concat('G', id) as primary_genre",
        "cast(id % 10 as double) as averageRating", "'1990' as start_decade")
    frame = titles.select(*[
        (F.col(f.name) if f.name in titles.columns else F.lit(None)).cast(f.type).alias(f.name)
        for f in TITLES.fields])
    write_layer(frame, f"{tmp_path}/{TITLES.name}", TITLES.partition_by)
    for mart in (EPISODES, CREDITS):
        write_layer(spark.createDataFrame([], mart.ddl), f"{tmp_path}/{mart.name}")
    main(["query", str(tmp_path), "q3_genre_decade_rating", f"{tmp_path}/out"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 300


def test_partitions_follow_from_the_input(spark, lake, conf, monkeypatch):
    conf(PARTITIONS, "4")
    size = stored_bytes(spark, [lake.bronze, f"{lake.bronze}/absent"])
    assert size > 100_000
    launched = dict(spark.sparkContext.getConf().getAll())
    monkeypatch.setattr(session, "shuffle_partitions", lambda n, cores: n // 1000)
    job_session("sized", [lake.bronze])
    # the tests' launcher sets the number, which stands
    assert PARTITIONS in launched and spark.conf.get(PARTITIONS) == "4"
    monkeypatch.setattr(session, "launched", lambda spark: {})
    main(["corrupt", lake.bronze, f"{lake.root}/corrupt"])
    assert spark.conf.get(PARTITIONS) == str(size // 1000)
