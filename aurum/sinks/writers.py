"""Table writers.

Bronze is append-only and partitioned by batch id, so a replay is a
partition filter and a rerun of a batch can replace exactly that batch.
Silver and gold are replaced per partition (dynamic overwrite) so a rerun is
idempotent and untouched partitions survive.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def write_bronze(df: DataFrame, path: str, batch_id: str | None = None,
                 compression: str = "snappy", replace_batch: bool = True) -> bool:
    """Append one batch under ``path/_batch_id=<id>``; ``False`` (and a warning) on failure.

    With ``replace_batch`` a rerun of the same batch id replaces that batch
    only (dynamic partition overwrite) instead of appending it twice.
    """
    if batch_id is not None:
        df = df.withColumn("_batch_id", F.lit(batch_id))
    try:
        w = df.write.partitionBy("_batch_id").option("compression", compression)
        if replace_batch:
            w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            w = w.mode("append")
        w.parquet(path)
        return True
    except Exception as exc:  # the caller decides whether a failed source stops the run
        log.warning("bronze write to %s failed: %s", path, exc)
        return False


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                fmt: str = "parquet", options: dict | None = None) -> None:
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by, fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (idempotent partition overwrite)."""
    (df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).save(path))


def write_split(flagged: DataFrame, path: str, reason_col: str = "rejection_reason",
                partition_by=(), fmt: str = "parquet") -> None:
    """Write clean and rejected rows in ONE pass, as partitions ``_outcome=clean|quarantine``.

    Two filtered writes would scan and evaluate the input twice; a single
    partitioned write evaluates the contract once, and readers prune to the
    outcome they need.
    """
    outcome = F.when(F.col(reason_col).isNull(), F.lit("clean")).otherwise(F.lit("quarantine"))
    write_table(flagged.withColumn("_outcome", outcome), path, "overwrite",
                ["_outcome", *partition_by], fmt)


# microsecond timestamps in messages (the JSON default keeps milliseconds only)
JSON_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                     "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode_json(df: DataFrame, cols=None, name: str = "value") -> DataFrame:
    """Row -> one JSON document per row (the message encoding of an event stream)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols), JSON_TIME_OPTIONS).alias(name))


def broker_messages(df: DataFrame, topic: str, key: str, cols=None) -> DataFrame:
    """``topic, key, value`` of every row, the frame that a broker writer takes (``value`` as in ``encode_json``)."""
    return df.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*(cols or df.columns)), JSON_TIME_OPTIONS).alias("value"))


def write_events_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one message per line (stand-in for a topic when no broker is present)."""
    encode_json(df).write.mode(mode).text(path)
