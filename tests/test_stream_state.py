"""Stateful de-duplication over restarts, and continuous runs with one metric record a micro-batch."""

import json
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.operators import metrics as MT
from aurum.streaming import events as S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.StringType())])


def _add(spark, path, rows, parts=1):
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").repartition(parts).write.mode("append").text(path)


def _stream(spark, path, per_trigger=None):
    return S.parse_payload(S.file_source(spark, path, max_files_per_trigger=per_trigger), SCHEMA, keep_payload=False)


def test_first_deliveries_survive_restarts_without_reading_the_table(spark, scratch):
    src, table, cp = f"{scratch}/in", f"{scratch}/out", f"{scratch}/cp"
    records = []
    listener = S.BatchMetrics(records.append)
    spark.streams.addListener(listener)
    try:
        _add(spark, src, [{"id": i, "ts": "2024-06-01"} for i in range(60)] + [{"id": 3, "ts": "2024-06-01"}, {"ts": "no id"}], 3)
        S.run_first_deliveries(_stream(spark, src, 1), ["id"], table, cp)
        # a restart: copies of old keys, keys older than all seen, another row without a key
        _add(spark, src, [{"id": i, "ts": "2024-06-01"} for i in range(50, 60)] +
             [{"id": i, "ts": "1999-01-01"} for i in range(100, 110)] + [{"ts": "no id either"}])
        S.run_first_deliveries(_stream(spark, src, 1), ["id"], table, cp)
        S.run_first_deliveries(_stream(spark, src, 1), ["id"], table, cp)         # nothing new
        deadline = time.monotonic() + 20
        while len(records) < 4 and time.monotonic() < deadline:                   # listeners are told later
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    clean, rejected = S.delivered(spark, table, SCHEMA)
    assert sorted(r.id for r in clean.collect()) == [*range(60), *range(100, 110)]
    assert sorted(r.ts for r in rejected.collect()) == ["no id", "no id either"]
    assert [r["rows_input"] for r in records][-1] == 21                          # the last batch read its own rows only
    assert records[-1]["state_rows"] == 72 and len(records) == 4                # 70 keys, 2 rows without one
    assert all(r["status"] == "SUCCESS" and r["latency_seconds"] > 0 for r in records)


def test_only_empty_sides(spark, scratch):
    clean, rejected = S.delivered(spark, f"{scratch}/none", SCHEMA)
    assert clean.count() == 0 and rejected.count() == 0
    _add(spark, f"{scratch}/in", [{"ts": "a"}, {"ts": "a"}])
    S.run_first_deliveries(_stream(spark, f"{scratch}/in"), ["id"], f"{scratch}/out", f"{scratch}/cp")
    clean, rejected = S.delivered(spark, f"{scratch}/out", SCHEMA)
    assert clean.count() == 0 and rejected.count() == 2                          # rows without a key are not one another's copies


def test_a_continuous_run_stops_when_idle_and_logs_each_batch(spark, scratch):
    src = f"{scratch}/in"
    log = MT.json_sink(spark, f"{scratch}/log")
    records = []
    listener = S.BatchMetrics(records.append)
    spark.streams.addListener(listener)
    try:
        _add(spark, src, [{"id": i, "ts": "x"} for i in range(8)], 4)
        S.run_until_idle(lambda: S.start_sink(_stream(spark, src, 2), f"{scratch}/out", f"{scratch}/cp",
                                              trigger={"processingTime": "500 milliseconds"}, query_name="measurements"), 2.0)
        deadline = time.monotonic() + 20
        while len(records) < 2 and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(f"{scratch}/out").count() == 8
    assert len(records) >= 2 and sum(r["rows_input"] for r in records) == 8      # two triggers or more
    assert {r["stage"] for r in records} == {"measurements"}
    for r in records:
        log(r)
    stored = spark.read.json(f"{scratch}/log")
    assert stored.agg(F.sum("rows_input")).first()[0] == 8
