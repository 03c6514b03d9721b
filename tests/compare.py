"""Compare every registered query with its SQL counterpart in DuckDB.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

TYPE_NAMES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types or rows; empty if nothing does."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), "?") for f in df.schema}
    if types != expected_types:
        return [f"columns {types} but expected {expected_types}"]
    order = sorted(types)
    got = Counter(tuple(r[c] for c in order) for r in df.collect())
    picked = relation.select(*[f'"{c}"' for c in order])
    expected = Counter(picked.fetchall())
    extra, lacking = got - expected, expected - got
    found = []
    if extra or lacking:
        found.append(f"{sum(got.values())} rows, expected {sum(expected.values())}; "
                     f"extra {list(extra)[:3]}, lacking {list(lacking)[:3]}")
    return found


def main(sf_dir: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.perf_counter()
        df = query(spark, sf_dir)
        if name not in oracle:
            print(f"{name}: {df.count()} rows, no SQL")
            continue
        found = differences(df, con, oracle[name])
        failed += bool(found)
        print(f"{name}: {'; '.join(found) or 'equal'} "
              f"({time.perf_counter() - started:.1f} s)", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
