"""Join operators: optional enrichment, lookups, roles, orphans.

Join strategies are left to Catalyst: it broadcasts a side only when its size
is under ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits
skewed partitions of sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(
    df: DataFrame, dim: DataFrame, key: str, flag: tuple[str, str] | None = None
) -> DataFrame:
    """Optional enrichment: every row of ``df``, with ``dim`` columns if matched.

    ``flag=(name, column)`` adds a boolean telling whether ``column`` has a value. This is a
    left join, written as the matches and the rows without any: adaptive execution can
    split a hot key on both sides of an inner join, but only on the left side of a left join. The
    second join meets each key of ``dim`` once, after partial aggregation. Rows without a key are set
    apart first, so both joins ask for the same rows of ``df`` and share one scan and shuffle of them.
    """
    keyed, absent = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
    matched = keyed.join(dim, key)
    alone = keyed.join(
        dim.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti").unionByName(absent)
    joined = matched.unionByName(alone, allowMissingColumns=True)
    if flag:
        name, column = flag
        joined = joined.withColumn(name, F.col(column).isNotNull())
    return joined


def with_role(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    dim_key: str,
    columns: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Join ``dim`` in one role, taking ``columns`` (source name -> role name).

    The same dimension can be joined several times under different names.
    ``how="inner"`` is a required lookup, ``how="left"`` an optional one.
    """
    role = dim.select(
        F.col(dim_key).alias("_role_key"),
        *[F.col(source).alias(name) for source, name in columns.items()],
    )
    matched = df.join(role, F.col(left_key) == F.col("_role_key"), how)
    return matched.drop("_role_key")


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose ``key`` has no match, NULL keys included."""
    known = dim.select(F.col(dim_key or key).alias("_known"))
    return fact.join(known, F.col(key) == F.col("_known"), "left_anti")
