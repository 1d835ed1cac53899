"""Structured Streaming: parse, lineage, bronze sink, in-stream de-duplication, split."""

from aurum.streaming.events import (
    EVENT_SCHEMA, with_corrupt_field, parse_payload, with_stream_lineage, kafka_source,
    file_source, start_sink, dedupe_within_watermark, split_writer, run_available, upsert_writer,
    first_deliveries, run_first_deliveries, delivered, BatchMetrics, run_until_idle,
)

__all__ = ["EVENT_SCHEMA", "with_corrupt_field", "parse_payload", "with_stream_lineage",
           "kafka_source", "file_source", "start_sink", "dedupe_within_watermark",
           "split_writer", "run_available", "upsert_writer", "first_deliveries", "run_first_deliveries",
           "delivered", "BatchMetrics", "run_until_idle"]
