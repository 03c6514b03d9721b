"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest one, or to the node."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the smallest one."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    neighbours = down.join(least, "a").where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return neighbours.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, work: str) -> DataFrame:
    """Of links (a, b) between different numbers: node and component, the least number in it.

    Nodes without links, and the least of each component, have no row. Every round is
    stored under ``work``; the number of links never grows, and both steps aggregate before they
    join, where adaptive execution may split a hub's links. The loop ends when a
    round changes nothing.
    """
    spark = links.sparkSession
    before, number = None, 0
    links.select("a", "b").distinct().write.parquet(f"{work}/round-0")
    while True:
        stored = spark.read.parquet(f"{work}/round-{number}")
        state = stored.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return stored.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before, number = state, number + 1
        _small_star(_large_star(stored)).write.parquet(f"{work}/round-{number}")
