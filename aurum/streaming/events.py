"""Event streams.

Every function takes and returns a (streaming or batch) DataFrame, so the
same parse/contract code runs on a broker source in production and on a file
source in tests.  Writers are checkpointed; a restarted query resumes from
its checkpoint and a re-run of an epoch replaces that epoch's output.
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from aurum import config as C
from aurum.operators.dedupe import latest_per_key
from aurum.sinks.writers import JSON_TIME_OPTIONS
from aurum.sources.readers import read_declared

# The fields of a measurement event (one JSON object per message).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("id_municipio", T.StringType(), False),
    T.StructField("sigla_uf", T.StringType(), False),
    T.StructField("ano", T.IntegerType(), False),
    T.StructField("media_proficiencia_saeb", T.DoubleType(), True),
    T.StructField("indicador_alfabetizacao", T.DoubleType(), True),
    T.StructField("total_alunos_avaliados", T.IntegerType(), True),
    T.StructField("timestamp_medicao", T.StringType(), True),
])

CORRUPT = "_corrupt_record"


def with_corrupt_field(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_payload(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, payload_col: str = "value",
                  keep_payload: bool = True) -> DataFrame:
    """bytes/text -> struct -> flat columns.

    Malformed or wrong-typed messages keep their raw text in
    ``_corrupt_record`` (and ``_payload``) instead of turning into an
    anonymous all-null row.
    """
    text = F.col(payload_col).cast("string")
    parsed = F.from_json(text, with_corrupt_field(schema),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_TIME_OPTIONS})
    cols = [parsed.alias("_data")] + ([text.alias("_payload")] if keep_payload else [])
    return df.select(*cols).select("_data.*", *(["_payload"] if keep_payload else []))


def malformed_reason() -> Column:
    return F.when(F.col(CORRUPT).isNotNull(), F.lit(C.REASON_MALFORMED))


def with_stream_lineage(df: DataFrame, topic: str) -> DataFrame:
    return df.withColumns({"_ingestion_timestamp": F.current_timestamp(),
                           "_source_topic": F.lit(topic)})


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", **options) -> DataFrame:
    """Broker source (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def file_source(spark: SparkSession, path: str, fmt: str = "text", schema: T.StructType | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A directory of message files as a stream (text: one message per line in ``value``)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _apply_trigger(w, trigger: dict | None):
    trigger = trigger or {"availableNow": True}
    return w.trigger(**trigger)


def start_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
               trigger: dict | None = None, partition_by=None, query_name: str | None = None):
    """Append a stream to files with a checkpoint; ``trigger`` e.g. ``{"processingTime": "10 seconds"}``."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    return _apply_trigger(w, trigger).start(path)


def dedupe_within_watermark(df: DataFrame, keys, event_time: str, delay: str = "1 hour") -> DataFrame:
    """At-least-once de-duplication: state is kept per key only within the watermark.

    The event-time column is cast to ``timestamp`` (watermarks refuse
    ``timestamp_ntz``); the state store is bounded by the watermark delay.
    Spark drops rows that are older than the watermark, first deliveries too:
    where none may be lost, use ``first_delivery_writer``.
    """
    ts = df.schema[event_time].dataType
    if isinstance(ts, T.TimestampNTZType):
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def split_writer(clean_path: str, quarantine_path: str, reason: Callable[[], Column],
                 fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: each micro-batch goes to clean or quarantine once.

    The batch is written as ``_epoch=<id>`` partitions with dynamic overwrite,
    so a replayed epoch (after a failure) replaces its output, not doubles it.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        flagged = batch.withColumn("rejection_reason", reason()).withColumn("_epoch", F.lit(epoch_id).cast("long"))
        flagged = flagged.persist()
        try:
            for path, cond in ((clean_path, F.col("rejection_reason").isNull()),
                               (quarantine_path, F.col("rejection_reason").isNotNull())):
                part = flagged.where(cond)
                if path == clean_path:
                    part = part.drop("rejection_reason")
                else:
                    part = part.withColumn("_quarantine_timestamp", F.current_timestamp())
                (part.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     .partitionBy("_epoch").save(path))
        finally:
            flagged.unpersist()
    return write


def split_tables(spark: SparkSession, clean_path: str, quarantine_path: str, schema: T.StructType,
                 fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """What ``split_writer`` wrote for rows of ``schema``; a side that got no row is an empty frame."""
    epoch = T.StructField("_epoch", T.LongType())
    rejected = [T.StructField("rejection_reason", T.StringType()), T.StructField("_quarantine_timestamp", T.TimestampType())]
    return (read_declared(spark, clean_path, T.StructType([*schema.fields, epoch]), fmt),
            read_declared(spark, quarantine_path, T.StructType([*schema.fields, *rejected, epoch]), fmt))


def first_delivery_writer(table: str, quarantine: str, keys, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: a row goes into ``table`` unless its key is there already, however late it comes.

    Rows without a whole key go to ``quarantine``.  Both are partitioned by
    ``_epoch``: a replayed epoch does not see its own rows and replaces them.
    Only the key columns of the stored table are read, for the keys of the batch.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        flagged = batch.withColumn("_epoch", F.lit(epoch_id).cast("long")).persist()
        try:
            seen = read_declared(spark, table, flagged.schema, fmt).where(F.col("_epoch") != epoch_id).select(*keys)
            fresh = latest_per_key(flagged.where(whole), keys, [], descending=False).join(seen, list(keys), "left_anti")
            rejects = flagged.where(~whole).withColumn("rejection_reason", F.lit(C.REASON_COMPLETENESS))
            for path, part in ((table, fresh.select(*flagged.columns)), (quarantine, rejects)):
                (part.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     .partitionBy("_epoch").save(path))
        finally:
            flagged.unpersist()
    return write


#: Keys of de-duplication live on the executors' disks and are saved as changes, so state may outgrow memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def first_deliveries(df: DataFrame, keys) -> DataFrame:
    """The first delivery of every key, however late the others come; rows without a whole key pass unchanged.

    The keys seen are the stream's state: a micro-batch looks up its own keys there and never reads the stored table, so
    its cost follows the batch.  State holds keys only (a random one for each row without a whole key, so that the
    source is read once for both kinds), for the stream's whole life; where keys may be forgotten,
    ``dedupe_within_watermark`` bounds it.  Of copies inside one micro-batch, one stays.
    """
    apart = F.when(~_whole(keys), F.expr("uuid()"))
    return df.withColumn("_apart", apart).dropDuplicates([*keys, "_apart"]).drop("_apart")


def _whole(keys) -> Column:
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return whole


def run_first_deliveries(df: DataFrame, keys, table: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Run ``first_deliveries`` over everything available now, into ``table``; then stop.

    One write an epoch: ``_outcome=clean`` holds the first deliveries, ``_outcome=quarantine`` rows without a whole key.  A
    replayed epoch starts from the same state and replaces its partitions.
    """
    spark = df.sparkSession
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)

    def write(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("_outcome", F.when(_whole(keys), "clean").otherwise("quarantine"))
              .withColumn("_epoch", F.lit(epoch_id).cast("long"))
              .write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("_outcome", "_epoch").save(table))

    run_available(first_deliveries(df, keys), checkpoint, write)


def delivered(spark: SparkSession, table: str, schema: T.StructType, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """First deliveries and rows without a whole key, as ``run_first_deliveries`` wrote them; either may be empty."""
    stored = read_declared(spark, table, T.StructType([*schema.fields, T.StructField("_outcome", T.StringType()),
                                                       T.StructField("_epoch", T.LongType())]), fmt)
    clean = stored.where(F.col("_outcome") == "clean").drop("_outcome")
    rejected = stored.where(F.col("_outcome") == "quarantine").drop("_outcome")
    return clean, rejected.withColumn("rejection_reason", F.lit(C.REASON_COMPLETENESS))


class BatchMetrics(StreamingQueryListener):
    """One metric record for every micro-batch of the session's streams, handed to ``sink`` as it ends.

    ``spark.streams.addListener(BatchMetrics(sink))``; idle triggers without input give no record.
    """

    def __init__(self, sink: Callable[[dict], None]) -> None:
        self.sink = sink

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            self.sink({"stage": p.name or "stream", "query_id": str(p.id), "batch_id": str(p.batchId),
                       "rows_input": p.numInputRows, "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
                       "latency_seconds": p.batchDuration / 1000.0, "status": "SUCCESS", "timestamp": p.timestamp})

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.sink({"stage": "stream", "query_id": str(event.id), "batch_id": None, "rows_input": 0, "state_rows": 0,
                       "latency_seconds": 0.0, "status": "ERROR", "timestamp": None, "error": event.exception.splitlines()[0]})


def run_until_idle(start: Callable[[], object], idle_seconds: float = 5.0, poll_seconds: float = 0.2):
    """Start a continuous query (a processing-time trigger) and stop it once it has been idle for ``idle_seconds``.

    The stop waits for the running micro-batch, so none is cut short; returns the stopped query.
    """
    query = start()
    idle_since = None
    while query.isActive:
        status = query.status
        busy = status["isDataAvailable"] or status["isTriggerActive"]
        now = time.monotonic()
        idle_since = None if busy else idle_since or now
        if idle_since is not None and now - idle_since >= idle_seconds:
            break
        query.awaitTermination(poll_seconds)
    query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def run_available(df: DataFrame, checkpoint: str, batch_fn: Callable[[DataFrame, int], None]) -> None:
    """Run a ``foreachBatch`` query over everything available now, then stop."""
    q = (df.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(batch_fn).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def upsert_writer(table: str, keys, order_cols, buckets: int = 64,
                  fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` keyed merge: each micro-batch rewrites only the buckets it touches.

    See ``operators.merge.merge_into_buckets``; re-running an epoch after a
    failure produces the same buckets again (idempotent).
    """
    from aurum.operators.merge import merge_into_buckets

    def write(batch: DataFrame, epoch_id: int) -> None:
        merge_into_buckets(batch, table, keys, order_cols, buckets, fmt)
    return write
