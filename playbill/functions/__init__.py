"""Column expressions (all native Spark functions)."""

from playbill.functions.columns import (
    decade, first_known, first_of, split_list, to_int,
)

__all__ = ["decade", "first_known", "first_of", "split_list", "to_int"]
