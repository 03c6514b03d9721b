"""Time the six named queries on Gold Parquet and print one JSON line.

Each figure is the median of three runs of plan, execute and collect, over views
registered beforehand. The stand-in catalogue comes from $BENCH_SF_DIR; its orders,
line items and suppliers can be multiplied with $BENCH_COPIES to reach the size of
a full catalogue. $BENCH_CPUS and $BENCH_MEMORY set the machine.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract import standin  # noqa: E402
from playbill import SUITE, publish_gold, run_gold, run_query, run_silver, workspace  # noqa: E402
from playbill import schemas as S  # noqa: E402
from playbill.session import JOB_CONF  # noqa: E402
from playbill.sources import read_layer, register_views  # noqa: E402

RUNS = 3


def timed(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def multiplied(given: dict[str, DataFrame], copies: int) -> dict[str, DataFrame]:
    """The given tables with shifted copies of orders, their lines and suppliers."""
    if copies == 1:
        return given
    # copy c of key k is k + c * (number of keys), which stays unique
    spans = {"o_orderkey": given["orders"].count(), "s_suppkey": given["supplier"].count()}
    spans |= {"l_orderkey": spans["o_orderkey"], "l_suppkey": spans["s_suppkey"]}
    result = dict(given)
    for name in ("orders", "lineitem", "supplier"):
        df = given[name].withColumn(
            "_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        for key in spans.keys() & set(df.columns):
            df = df.withColumn(key, F.col(key) + F.col("_copy") * spans[key])
        result[name] = df.drop("_copy")
    return result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    root = os.environ.get("BENCH_LAKE")  # reuse a lake built by an earlier run
    builder = SparkSession.builder
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs: dict[str, float] = {}
    given = multiplied(standin.tables(spark, sf_dir), copies)
    lake = standin.Lake(spark, given, root or workspace(spark))
    if not root:
        jobs["write_raw"] = timed(lambda: lake.with_raw(*S.BRONZE))
        jobs["silver"] = timed(lambda: run_silver(spark, lake.bronze, lake.silver))
        jobs["gold"] = timed(lambda: run_gold(spark, lake.silver, lake.gold))
        if os.environ.get("BENCH_PUBLISH", "1") == "1":
            jobs["publish"] = timed(lambda: publish_gold(
                spark, lake.gold, "bench", f"{lake.root}/tables").collect())

    register_views(spark, lake.gold, S.GOLD)
    queries = {
        name: statistics.median(
            timed(lambda: run_query(spark, name).collect()) for _ in range(RUNS))
        for name in SUITE
    }
    rows = {t.name: read_layer(spark, lake.gold, t).count() for t in S.GOLD}
    print(json.dumps({
        "metric": "total of the six catalogue queries, median of 3",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": {name.split("_")[0]: round(sec, 3) for name, sec in queries.items()},
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "copies": copies,
        "rows": rows,
        "jobs": {name: round(sec, 3) for name, sec in jobs.items()},
        "lake": lake.root,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
