"""Top-k rows and groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def top_groups(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    order: Sequence[Column],
    k: int | None = None,
    min_count: int | None = None,
) -> DataFrame:
    """Aggregate, drop groups under ``min_count`` rows, sort, keep ``k`` groups."""
    size = [F.count("*").alias("_size")] if min_count else []
    groups = df.groupBy(*keys).agg(*aggs, *size)
    if min_count:
        groups = groups.where(F.col("_size") >= min_count).drop("_size")
    groups = groups.orderBy(*order)
    return groups if k is None else groups.limit(k)


def top_keys(df: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """Keys of the ``k`` groups with the largest ``max(score)``; ties go by key."""
    groups = df.groupBy(key).agg(F.max(score).alias("_max"))
    return top_rows(groups, [F.desc_nulls_last("_max"), F.asc(key)], k).select(key)


def keep_top_groups(df: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """Rows of the ``k`` groups with the largest ``max(score)``."""
    return df.join(top_keys(df, key, score, k), key, "left_semi")
