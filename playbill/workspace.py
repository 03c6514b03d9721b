"""Where jobs keep intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def workspace(spark: SparkSession) -> str:
    """A new, unused directory every executor can reach.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``, or where that is
    unset in the warehouse, which all executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{root.rstrip('/')}/playbill-{uuid.uuid4().hex[:12]}"
