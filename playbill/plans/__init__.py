"""Layer jobs and the named-query suite."""

from playbill.plans.layers import corrupt_counts, publish_gold, run_all, run_gold, run_silver
from playbill.plans.suite import SUITE, run_query

__all__ = [
    "SUITE", "corrupt_counts", "publish_gold", "run_all", "run_gold", "run_query",
    "run_silver",
]
