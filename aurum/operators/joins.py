"""Joins against directories whose size is checked before broadcasting.

``broadcast()`` is applied only when the small side is counted to hold at most
``max_rows`` rows.  Beyond the bound the join is left to the planner
(sort-merge on the key, with AQE skew splitting), so a directory that grows
with the data never lands whole in every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.operators.dedupe import latest_per_key
from aurum.session import shared_path

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def row_width(schema: T.StructType) -> int:
    """A conservative in-memory width of one row (strings and nested values count 64 bytes)."""
    def width(t: T.DataType) -> int:
        if isinstance(t, (T.ByteType, T.BooleanType)):
            return 1
        if isinstance(t, (T.ShortType,)):
            return 2
        if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
            return 4
        if isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
            return 8
        if isinstance(t, T.DecimalType):
            return 16
        if isinstance(t, T.StructType):
            return sum(width(f.dataType) for f in t.fields)
        return 64
    return 16 + sum(width(f.dataType) for f in schema.fields)


def broadcast_row_bound(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                        max_bytes: int = DEFAULT_BROADCAST_BYTES) -> int:
    return max(1, min(max_rows, max_bytes // row_width(df.schema)))


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    # an aggregate: each task sends one count (of file footers, if ``df`` is a scan), never rows
    return df.count() <= max_rows


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: counting it again reads footers only."""
    path = shared_path(df.sparkSession, "materialised", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    probe: DataFrame | None = None, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df`` (a shuffle join).

    The bound is ``max_rows`` rows and at most ``max_bytes`` at a conservative
    width per row (``row_width``).  ``probe`` is a frame with at least as many
    rows as ``df`` that is cheaper to count, e.g. the raw directory before its
    de-duplication: counting a scan reads its file footers, while counting the
    de-duplicated frame would shuffle the whole directory once just to size it.
    """
    bound = broadcast_row_bound(df, max_rows, max_bytes)
    return F.broadcast(df) if is_bounded(probe if probe is not None else df, bound) else df


def join_directory(fact: DataFrame, directory: DataFrame, on, how: str = "left",
                   max_rows: int = DEFAULT_BROADCAST_ROWS, probe: DataFrame | None = None,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join a fact to a directory (one row per key is the caller's duty)."""
    return fact.join(maybe_broadcast(directory, max_rows, probe, max_bytes), on, how)


def version_intervals(versions: DataFrame, keys, version_col: str, order_cols=()) -> DataFrame:
    """Directory rows with the interval of versions in which they hold: ``valid_from`` up to (not at) ``valid_to``.

    Of several rows of a key in one version the last by ``order_cols`` holds; the newest row has no end.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    one = latest_per_key(versions, [*keys, version_col], list(order_cols))
    until = F.lead(version_col).over(Window.partitionBy(*keys).orderBy(version_col))
    return one.withColumn("valid_from", F.col(version_col)).withColumn("valid_to", until).drop(version_col)


def join_as_of(facts: DataFrame, versions: DataFrame, keys, fact_version: str, version_col: str, order_cols=(),
               probe: DataFrame | None = None) -> DataFrame:
    """Left join of every fact with the directory row that held at the fact's own version.

    A later delivery of the directory does not change what an older batch is enriched with, so a replay of that batch gives
    the names of its time.  An equi-join on the keys with a range condition: a broadcast once the directory's size is
    proven, else a shuffle join that adaptive execution can split.  Facts older than the first version have nulls.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    held = version_intervals(versions, keys, version_col, order_cols)
    held = held.select(*[F.col(k).alias(f"_dir_{k}") for k in keys], *[c for c in held.columns if c not in keys])
    at = F.col(fact_version)
    on = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_dir_{k}"))
    return facts.join(maybe_broadcast(held, probe=probe), on, "left").drop("valid_from", "valid_to", *[f"_dir_{k}" for k in keys])
