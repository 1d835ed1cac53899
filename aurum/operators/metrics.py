"""Stage metrics: a context that times a stage, takes its counts, alerts and publishes the metric.

``observed`` attaches counters to a plan so they fill in during its own
action (no extra pass); the layered run itself reads counts back from the
written tables, which stay exact when failed tasks are re-run.
"""

from __future__ import annotations

import json
import logging
import sys
import time
import traceback
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone
from decimal import ROUND_HALF_UP, Decimal
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum import config as C
from aurum.functions.literals import literal_frame
from aurum.functions.rounding import round_half_up
from aurum.operators.joins import maybe_broadcast

log = logging.getLogger("aurum.metrics")

METRIC_KEYS = ("rows_input", "rows_clean", "rows_quarantined", "rows_duplicate", "quarantine_rate_pct")

METRIC_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("rows_input", T.LongType()),
    T.StructField("rows_clean", T.LongType()),
    T.StructField("rows_quarantined", T.LongType()),
    T.StructField("rows_duplicate", T.LongType()),
    T.StructField("quarantine_rate_pct", T.DoubleType()),
    T.StructField("latency_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("traceback", T.StringType()),
])

ALERT_TEXT = "quarantine rate %s%% exceeds the %s%% threshold"


@dataclass
class StageMetrics:
    stage: str
    batch_id: str
    rows_input: int | None = None
    rows_clean: int | None = None
    rows_quarantined: int | None = None
    rows_duplicate: int | None = None
    quarantine_rate_pct: float | None = None
    latency_seconds: float | None = None
    status: str = "RUNNING"
    timestamp: str = ""
    error: str | None = None
    traceback: str | None = None

    def balanced(self) -> bool:
        """input = clean + quarantined + duplicates (when all are known)."""
        parts = (self.rows_input, self.rows_clean, self.rows_quarantined)
        if any(p is None for p in parts):
            return True
        return self.rows_input == self.rows_clean + self.rows_quarantined + (self.rows_duplicate or 0)

    def as_dict(self) -> dict:
        return asdict(self)


def quarantine_rate(rejected: int, total: int) -> float:
    """round(rejected / total * 100, 2), half-up on the decimal text of the double; 0 without input."""
    if not total:
        return 0.0
    return float(Decimal(repr(rejected * 100.0 / total)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def alert_for(metric: dict, threshold: float = 10.0) -> dict | None:
    """The metric as an alert record if its quarantine rate is above ``threshold``, else None."""
    rate = metric.get("quarantine_rate_pct") or 0.0
    return {**metric, "level": C.ALERT_LEVEL, "message": ALERT_TEXT % (rate, threshold)} if rate > threshold else None


class StageRun:
    """One run of a stage as a context: ``with StageRun("silver", publish) as run: run.report(counts)``.

    On leaving, the latency, the outcome (an exception with its traceback, which goes on) and the reported counts
    are published as one metric, and an alert goes to the log and to standard error if the rate calls for it.
    Publishing is best effort: its own failure is logged and does not fail the stage.
    """

    def __init__(self, stage: str, publish: Callable[[dict], None] | None = None, threshold: float = 10.0,
                 batch_id: str | None = None) -> None:
        self.publish, self.threshold = publish, threshold
        started = datetime.now(timezone.utc)
        self.metrics = StageMetrics(stage, batch_id or f"{started:%Y%m%d_%H%M%S}", timestamp=started.isoformat())

    def __enter__(self) -> "StageRun":
        self._clock = time.monotonic()
        return self

    def report(self, counts: dict) -> dict:
        """Take over the known counts; returns ``counts``."""
        self.metrics = replace(self.metrics, **{k: counts[k] for k in METRIC_KEYS if k in counts})
        return counts

    def __exit__(self, kind, error, trace) -> None:
        failed = {} if error is None else {
            "error": str(error), "traceback": "".join(traceback.format_exception(kind, error, trace))}
        self.metrics = replace(self.metrics, latency_seconds=round(time.monotonic() - self._clock, 2),
                               status="SUCCESS" if error is None else "ERROR", **failed)
        record = self.metrics.as_dict()
        alert = alert_for(record, self.threshold) if error is None else None
        if alert:
            print(json.dumps(alert, default=str), file=sys.stderr)
        log.log(logging.WARNING if alert else logging.INFO, "%s", json.dumps(alert or record, default=str))
        if self.publish is not None:
            try:
                self.publish(record)
            except Exception:
                log.warning("the metric of %s was not published", record["stage"], exc_info=True)


def observed(df: DataFrame, name: str, reason_col: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach row (and reject) counters that fill in during the next action on ``df``."""
    obs = Observation()  # unnamed: a unique name per attachment
    exprs = [F.count(F.lit(1)).alias("rows")]
    if reason_col:
        exprs.append(F.count_if(F.col(reason_col).isNotNull()).alias("rejected"))
    return df.observe(obs, *exprs), obs


def metrics_frame(spark: SparkSession, metrics: list[dict]) -> DataFrame:
    rows = [{f.name: m.get(f.name) for f in METRIC_SCHEMA.fields} for m in metrics]
    return literal_frame(spark, rows, METRIC_SCHEMA)


def json_sink(spark: SparkSession, root: str) -> Callable[[dict], None]:
    """Append each metric as one JSON line under ``root/date=YYYY-mm-dd``."""
    def write(metric: dict) -> None:
        df = metrics_frame(spark, [metric]).withColumn("date", F.substring("timestamp", 1, 10))
        df.coalesce(1).write.mode("append").partitionBy("date").json(root)
    return write


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The metrics that ``json_sink`` wrote under ``root``."""
    return spark.read.schema(METRIC_SCHEMA).json(root)


def alerts(metrics: DataFrame, threshold: float = 10.0) -> DataFrame:
    return (metrics.where(F.col("quarantine_rate_pct") > threshold)
            .withColumn("level", F.lit(C.ALERT_LEVEL))
            .withColumn("message", F.format_string(ALERT_TEXT,
                                                    F.col("quarantine_rate_pct").cast("string"),
                                                    F.lit(str(threshold)))))


def unit_cost(metrics: DataFrame, costs: DataFrame, rows_col: str = "rows_input") -> DataFrame:
    """Cost per million rows processed: ``cost / rows * 1e6`` per stage."""
    j = metrics.join(maybe_broadcast(costs), "stage", "inner")
    return j.withColumn("cost_per_million_rows",
                        round_half_up(F.try_divide(F.col("cost") * F.lit(1e6), F.col(rows_col).cast("double")), 4))
