"""Keyed merges that work on any file format (no table-format engine needed)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.operators.dedupe import latest_delivery, latest_per_key
from aurum.sources.readers import no_table, read_declared


def upsert(base: DataFrame, changes: DataFrame, keys, order_cols) -> DataFrame:
    """Merge ``changes`` into ``base``: per key the latest row by ``order_cols`` wins.

    Portable MERGE: ``unionByName`` + latest-per-key.  Ties on the order
    columns prefer the change row, then fall back to the other columns.
    """
    tagged = (base.withColumn("_from_change", F.lit(0))
              .unionByName(changes.withColumn("_from_change", F.lit(1)), allowMissingColumns=True))
    merged = latest_per_key(tagged, keys, list(order_cols) + ["_from_change"])
    return merged.drop("_from_change")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """Rows of ``incoming`` whose content key is not yet stored (``ON CONFLICT DO NOTHING``)."""
    fresh = latest_per_key(incoming, keys, [])
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def append_if_absent(existing: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """The table after an insert-if-absent: stored rows plus the new keys only."""
    return existing.unionByName(insert_if_absent(existing, incoming, keys).select(*existing.columns))


def merge_measurements(fact: DataFrame, updates: DataFrame, keys, cols, ts_col: str) -> DataFrame:
    """Newer measurements win, column by column; the fact's other columns are kept.

    ``fact`` and ``updates`` hold at most one row per key.  For a key in both,
    ``cols`` (and ``ts_col``) come from ``updates`` when its ``ts_col`` is newer
    or the fact has none; keys only in ``updates`` are added with the
    fact-only columns null.  Output columns keep the fact's types.
    """
    f, u = fact.alias("f"), updates.alias("u")
    j = f.join(u, [F.col(f"f.{k}") == F.col(f"u.{k}") for k in keys], "full_outer")
    in_f, in_u = F.col(f"f.{keys[0]}").isNotNull(), F.col(f"u.{keys[0]}").isNotNull()
    f_ts, u_ts = F.col(f"f.{ts_col}").cast("timestamp"), F.col(f"u.{ts_col}").cast("timestamp")
    newer = ~in_f | (in_u & (f_ts.isNull() | (u_ts > f_ts)))
    types = {fl.name: fl.dataType for fl in fact.schema.fields}
    out = []
    for c in fact.columns:
        if c in keys:
            v = F.coalesce(F.col(f"f.{c}"), F.col(f"u.{c}"))
        elif c not in updates.columns:
            v = F.col(f"f.{c}")
        elif c in cols or c == ts_col:
            v = F.when(newer, F.col(f"u.{c}").cast(types[c])).otherwise(F.col(f"f.{c}"))
        else:   # descriptive columns: the fact's, filled for new keys
            v = F.coalesce(F.col(f"f.{c}"), F.col(f"u.{c}").cast(types[c]))
        out.append(v.alias(c))
    out += [F.when(newer, F.col(f"u.{c}")).alias(c) for c in cols if c in updates.columns and c not in types]
    return j.select(*out)


def bucket_of(keys, buckets: int):
    """Stable hash bucket of a key (the layout of a bucketed merge table)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _table_buckets(spark, table: str, buckets: int) -> int:
    """The bucket count that ``table`` was made with, stored beside it; another one is refused."""
    layout = f"{table.rstrip('/')}_layout"
    stored = [r["buckets"] for r in read_declared(spark, layout, "buckets int", "json").collect()]
    if not stored:
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.json(layout)
    elif stored[0] != buckets:
        raise ValueError(f"{table} has {stored[0]} buckets, not {buckets}")
    return buckets


def _stored(spark, table: str, fmt: str) -> DataFrame | None:
    try:
        return spark.read.format(fmt).load(table)
    except AnalysisException as exc:
        if no_table(exc):
            return None
        raise


def merge_into_buckets(incoming: DataFrame, table: str, keys, order_cols, buckets: int = 64,
                       fmt: str = "parquet", deliveries: str | None = None) -> int:
    """Keyed merge of ``incoming`` into a table partitioned by ``_bucket`` (hash of the key).

    Only the buckets the incoming keys fall in are read, merged (latest row
    per key wins, incoming rows win ties) and rewritten: the work follows the
    size of the change, not of the table.  The number of buckets is a choice
    for the table's size (about 128 MB a bucket); it is stored with the table
    and a merge with another one is refused.  The change is staged under
    ``<table>_incoming`` (computed once) and the merged buckets under
    ``<table>_staging``, so no write overwrites files its own plan reads, then
    swapped in by dynamic partition overwrite.  Re-running the same merge
    gives the same table (idempotent).  Returns the number of touched buckets.

    With ``deliveries`` (a column that names a row's delivery) a key may have several rows: those of its latest
    delivery stay, and rows of a delivery that is merged again are replaced by its new ones.
    """
    spark = incoming.sparkSession
    buckets = _table_buckets(spark, table, buckets)
    base = table.rstrip("/")
    change = incoming.withColumn("_bucket", bucket_of(keys, buckets))
    change.write.format(fmt).mode("overwrite").save(f"{base}_incoming")
    change = spark.read.schema(change.schema).format(fmt).load(f"{base}_incoming")
    touched = [r["_bucket"] for r in change.select("_bucket").distinct().collect()]  # at most `buckets` ids
    if not touched:
        return 0
    stored = _stored(spark, table, fmt)
    if deliveries:
        if stored is not None:
            again = change.select(deliveries).distinct()  # one delivery, as a rule
            kept = stored.where(F.col("_bucket").isin(touched)).join(F.broadcast(again), deliveries, "left_anti")
            change = kept.select(*change.columns).unionByName(change)
        merged = latest_delivery(change, keys, order_cols)
    elif stored is None:
        merged = latest_per_key(change, keys, order_cols)
    else:
        merged = upsert(stored.where(F.col("_bucket").isin(touched)), change, keys, order_cols)
    staging = f"{base}_staging"
    merged.hint("rebalance", "_bucket").write.format(fmt).mode("overwrite").partitionBy("_bucket").save(staging)
    (spark.read.schema(merged.schema).format(fmt).load(staging).hint("rebalance", "_bucket")
          .write.format(fmt).mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").save(table))
    return len(touched)


ENVELOPE_SCHEMA = ("source string, record_key string, record_year int, rejection_reason string, payload string, "
                   "_quarantine_timestamp timestamp")
QUARANTINE_ENVELOPE = ("source", "record_key", "record_year", "rejection_reason", "payload",
                       "_quarantine_timestamp")


def to_envelope(rejects: DataFrame, source: str, key_cols, year_col: str | None = None,
                reason_col: str = "rejection_reason") -> DataFrame:
    """Wrap rejects of any schema into one fixed quarantine envelope.

    ``payload`` keeps the whole rejected row as JSON, so batch and stream
    rejects with different columns share one table.
    """
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols])
    payload_cols = [c for c in rejects.columns if c not in (reason_col, "_quarantine_timestamp")]
    ts = (F.col("_quarantine_timestamp") if "_quarantine_timestamp" in rejects.columns
          else F.current_timestamp())
    return rejects.select(
        F.lit(source).alias("source"),
        key.alias("record_key"),
        (F.col(year_col).cast("int") if year_col else F.lit(None).cast("int")).alias("record_year"),
        F.col(reason_col).alias("rejection_reason"),
        F.to_json(F.struct(*payload_cols)).alias("payload"),
        ts.alias("_quarantine_timestamp"),
    )


def union_envelopes(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
