"""Run a layer job or named queries.

    spark-submit ... playbill/__main__.py etl BRONZE SILVER GOLD [--quote '"'] [--strict-header]
        [--truncate] [--parent-fallback]
    spark-submit ... playbill/__main__.py corrupt BRONZE OUT
    spark-submit ... playbill/__main__.py publish GOLD DATABASE [--location DIR] [--append]
        [--buckets N] [--layout bucketed|sorted]
    spark-submit ... playbill/__main__.py query GOLD NAME OUT
    spark-submit ... playbill/__main__.py suite GOLD OUT

Results are written whole, as CSV with a header: ``query`` and ``corrupt`` to OUT, ``suite`` to a
folder below it for each query, where a query that fails does not keep the others from running. Without a cluster, ``python -m playbill`` does the same.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from playbill import SUITE, corrupt_counts, publish_gold, run_all, run_query
from playbill.schemas import GOLD
from playbill.session import job_session
from playbill.sources import register_views


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="playbill")
    jobs = parser.add_subparsers(dest="job", required=True)
    etl = jobs.add_parser("etl", help="raw text to Silver and Gold")
    for layer in ("bronze", "silver", "gold"):
        etl.add_argument(layer)
    etl.add_argument("--truncate", action="store_true", help="read 12.7 as 12 in integer columns")
    etl.add_argument("--parent-fallback", action="store_true",
                     help="an episode without a year takes its series' decade")
    corrupt = jobs.add_parser("corrupt", help="count unreadable lines of the raw files")
    corrupt.add_argument("bronze")
    corrupt.add_argument("out")
    for job in (etl, corrupt):
        job.add_argument("--quote", default="", help="quote character of the raw files")
        job.add_argument("--strict-header", action="store_true")
    publish = jobs.add_parser("publish", help="Gold marts to catalog tables")
    publish.add_argument("gold")
    publish.add_argument("database")
    publish.add_argument("--location")
    publish.add_argument("--append", action="store_true")
    publish.add_argument("--buckets", type=int)
    publish.add_argument("--layout", choices=("bucketed", "sorted"), default="bucketed")
    query = jobs.add_parser("query", help="a named query over Gold")
    query.add_argument("gold")
    query.add_argument("name", choices=SUITE)
    query.add_argument("out")
    suite = jobs.add_parser("suite", help="all named queries over Gold")
    suite.add_argument("gold")
    suite.add_argument("out")
    return parser.parse_args(argv)


def _write(df: DataFrame, path: str) -> None:
    """The whole result, in its order."""
    df.write.mode("overwrite").option("header", True).csv(path)


def run_suite(spark: SparkSession, out: str) -> None:
    """Write the result of each named query; one that fails is reported and the others go on.

    Ends with status 1 if none succeeded.
    """
    failed = []
    for name in SUITE:
        try:
            _write(run_query(spark, name), f"{out}/{name}")
        except Exception as error:
            failed.append(name)
            print(f"{name} failed: {error}", file=sys.stderr)
    if len(failed) == len(SUITE):
        raise SystemExit(1)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    layer = args.bronze if args.job in ("etl", "corrupt") else args.gold
    spark = job_session(f"playbill {args.job}", [layer])
    if args.job == "etl":
        run_all(spark, args.bronze, args.silver, args.gold, truncate=args.truncate,
                parent_fallback=args.parent_fallback, quote=args.quote,
                strict_header=args.strict_header)
    elif args.job == "corrupt":
        _write(corrupt_counts(spark, args.bronze, quote=args.quote,
                              strict_header=args.strict_header), args.out)
    elif args.job == "publish":
        mode = "append" if args.append else "overwrite"
        audit = publish_gold(spark, args.gold, args.database, args.location, mode,
                             buckets=args.buckets, layout=args.layout)
        audit.show(audit.count(), truncate=False)
    else:
        register_views(spark, args.gold, GOLD)
        if args.job == "query":
            _write(run_query(spark, args.name), args.out)
        else:
            run_suite(spark, args.out)


if __name__ == "__main__":
    main()
