import pytest

from aurum.operators import metrics as MT


def _run(counts, sink=None, stage="s"):
    with MT.StageRun(stage, sink, batch_id="b1") as run:
        return run.report(counts)


def test_a_stage_run_publishes_its_counts():
    seen = []
    counts = {"rows_input": 40, "rows_clean": 38, "rows_quarantined": 2, "quarantine_rate_pct": 5.0, "other": 1}
    assert _run(counts, seen.append) is counts
    (metric,) = seen
    assert (metric["status"], metric["batch_id"], metric["rows_clean"]) == ("SUCCESS", "b1", 38)
    assert metric["latency_seconds"] >= 0 and "other" not in metric


def test_a_failed_stage_goes_on_raising_and_keeps_its_traceback(spark, scratch):
    sink = MT.json_sink(spark, f"{scratch}/log")
    with pytest.raises(KeyError), MT.StageRun("broken", sink):
        {}["no such key"]
    row = MT.read_log(spark, f"{scratch}/log").first()
    assert row.status == "ERROR" and "no such key" in row.error and "KeyError" in row.traceback


def test_an_alert_needs_a_rate_above_the_threshold(capsys):
    _run({"rows_input": 50, "quarantine_rate_pct": 10.0})
    assert capsys.readouterr().err == ""
    _run({"rows_input": 50, "quarantine_rate_pct": 10.01})
    assert "CRITICAL_ALERT" in capsys.readouterr().err
    assert MT.alert_for({"quarantine_rate_pct": None}) is None


def test_a_sink_that_fails_does_not_fail_the_stage():
    def sink(_):
        raise OSError("disk gone")

    assert _run({"rows_input": 1}, sink) == {"rows_input": 1}


def test_rate_and_balance():
    assert MT.quarantine_rate(1, 8) == 12.5 and MT.quarantine_rate(0, 0) == 0.0
    assert MT.quarantine_rate(1, 200) == 0.5 and MT.quarantine_rate(1, 3) == 33.33
    m = MT.StageMetrics("s", "b", rows_input=10, rows_clean=7, rows_quarantined=2, rows_duplicate=1)
    assert m.balanced()
    m.rows_duplicate = 0
    assert not m.balanced()


def test_observed_counts_in_the_write_pass(spark, scratch):
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("rejection_reason", F.when(F.col("id") < 3, "x"))
    obs_df, obs = MT.observed(df, "t", "rejection_reason")
    obs_df.write.parquet(f"{scratch}/o")
    assert obs.get == {"rows": 10, "rejected": 3}


def test_metrics_frame_alerts_unit_cost_and_json_sink(spark, scratch):
    ms = [{"stage": "a", "rows_input": 2_000_000, "quarantine_rate_pct": 12.5, "timestamp": "2026-01-01T00:00:00"},
          {"stage": "b", "rows_input": 0, "quarantine_rate_pct": 1.0, "timestamp": "2026-01-01T00:00:00"}]
    df = MT.metrics_frame(spark, ms)
    assert [r.stage for r in MT.alerts(df).collect()] == ["a"]
    costs = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "stage string, cost double")
    got = {r.stage: r.cost_per_million_rows for r in MT.unit_cost(df, costs).collect()}
    assert got == {"a": 1.5, "b": None}
    sink = MT.json_sink(spark, f"{scratch}/log")
    sink(ms[0])
    sink(ms[1])
    assert spark.read.json(f"{scratch}/log").where("date = '2026-01-01'").count() == 2
