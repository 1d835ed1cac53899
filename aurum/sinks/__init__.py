"""Writers at the edge of the plans."""

from aurum.sinks.writers import (
    write_bronze, write_table, overwrite_partitions, write_split, encode_json, write_events_json,
)
from aurum.sinks.projections import kv_projection, format_fixed

__all__ = ["write_bronze", "write_table", "overwrite_partitions", "write_split", "encode_json",
           "write_events_json", "kv_projection", "format_fixed"]
