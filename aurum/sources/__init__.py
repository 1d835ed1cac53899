"""Readers: extracts, fall-back chains, bronze scans, lineage and replay."""

from aurum.sources.readers import (
    SourceSpec, read_first_available, read_csv_strings, read_bronze, extract, read_inputs,
)
from aurum.sources.lineage import (
    make_batch_id, batch_id_of, with_lineage, with_file_lineage, as_of_batch,
)
from aurum.sources.catalog import register_external

__all__ = [
    "SourceSpec", "read_first_available", "read_csv_strings", "read_bronze", "extract",
    "read_inputs", "make_batch_id", "batch_id_of", "with_lineage", "with_file_lineage",
    "as_of_batch", "register_external",
]
