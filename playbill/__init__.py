"""Catalogue lake on Spark: raw text to Silver, Gold, published tables and queries."""

from playbill.plans import (
    SUITE, corrupt_counts, publish_gold, run_all, run_gold, run_query, run_silver,
)
from playbill.workspace import workspace

__all__ = [
    "SUITE", "corrupt_counts", "publish_gold", "run_all", "run_gold", "run_query",
    "run_silver", "workspace",
]
