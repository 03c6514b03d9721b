"""Readers and writers: delimited text, Parquet layers, SQL views."""

from playbill.sources.delimited import corrupt_count, null_counts, read_delimited, write_delimited
from playbill.sources.layers import (
    partition_files, read_layer, register_views, write_layer,
)

__all__ = [
    "corrupt_count", "null_counts", "partition_files", "read_delimited", "read_layer",
    "register_views", "write_delimited", "write_layer",
]
