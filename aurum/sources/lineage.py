"""Lineage columns and batch replay."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_FORMAT = "%Y%m%d_%H%M%S"


def make_batch_id(now: datetime | None = None) -> str:
    """UTC ``YYYYmmdd_HHMMSS``; computed once on the driver and passed in."""
    return (now or datetime.now(timezone.utc)).strftime(BATCH_FORMAT)


def batch_id_of(ts, instant: bool = True) -> Column:
    """The batch id of a timestamp column, same format as ``make_batch_id``.

    For an instant (``timestamp``) the id is the UTC wall clock whatever the
    session time zone; pass ``instant=False`` for a ``timestamp_ntz`` column.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    if instant:
        c = F.to_utc_timestamp(c, F.current_timezone())
    return F.date_format(c, "yyyyMMdd_HHmmss")


def with_lineage(df: DataFrame, source: str, batch_id: str, ingested_at: str | None = None) -> DataFrame:
    """Same lineage values on every row of a batch: ISO time, source table, batch id."""
    ts = ingested_at or datetime.now(timezone.utc).isoformat()
    return df.withColumns({
        "_ingestion_timestamp": F.lit(ts),
        "_source_table": F.lit(source),
        "_batch_id": F.lit(batch_id),
    })


def with_file_lineage(df: DataFrame, name: str = "_source_file") -> DataFrame:
    """The file each row came from (file sources only)."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def as_of_batch(df: DataFrame, batch_id: str, col: str = "_batch_id") -> DataFrame:
    """Bronze as it stood after ``batch_id`` (append-only, so a filter; prunes partitions)."""
    return df.where(F.col(col) <= F.lit(batch_id))
