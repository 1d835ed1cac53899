"""Session construction and the shared scratch location.

Intermediate tables (bronze batches, stream sinks, checkpoints) are written
under the shared folder the cluster names in ``spark.checkpoint.dir``.  A
private temporary folder is created only when that setting is absent and the
master is local; on a cluster its absence is an error, because executors do
not see each other's disks.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "aurum", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temp dir only if unset on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all nodes of {master} share")
        root = tempfile.mkdtemp(prefix="aurum-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared folder: ``<root>/aurum/<parts>/<uuid>``."""
    segs = [shared_root(spark), "aurum", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(segs)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Shuffle and scan sizing for a given input volume and cluster size.

    Start with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the input (never fewer than twice the cores)
    and let AQE coalesce small ones and split skewed ones at run time.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


#: Input rows of one shuffle partition before adaptive execution merges small ones, and the bytes up to which it merges.
ROWS_PER_PARTITION = 250_000
MERGED_BYTES = 8 << 20
#: Bytes of a scan's split where map tasks sort or group what they read.
SPLIT_BYTES = 4 << 20
#: Bytes of one Arrow batch where a row is a block of vectors.
BATCH_BYTES = 16 << 20
_SIZING = threading.Lock()


def _bytes(text: str) -> int:
    """``64m``, ``67108864b`` or ``4096`` in bytes."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]?)b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let the shuffles of ``rows`` input rows start with so many partitions that a task's sort or hash map stays small.

    A fixed number of partitions makes each task's memory grow with the input.  The number is only raised and the merged
    size only lowered, so a session keeps what its largest table asked for and tiny inputs keep the configured number.
    """
    initial, merged = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    wanted = -(-rows // ROWS_PER_PARTITION)
    with _SIZING:
        held = spark.conf.get(initial, None)
        if wanted > int(held if held not in (None, "None", "<undefined>") else spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set(initial, str(wanted))
            if _bytes(spark.conf.get(merged)) > MERGED_BYTES:
                spark.conf.set(merged, f"{MERGED_BYTES}b")


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ``BATCH_BYTES`` at most: a Python worker has about two of them at a time.  Only lowered."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    with _SIZING:
        if not 0 < _bytes(spark.conf.get(key)) <= BATCH_BYTES:
            spark.conf.set(key, f"{BATCH_BYTES}b")


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Within it scans deal out splits of ``SPLIT_BYTES`` at most: what a map task sorts does not grow with the table."""
    key = "spark.sql.files.maxPartitionBytes"
    held = spark.conf.get(key)
    if _bytes(held) <= SPLIT_BYTES:
        yield
        return
    spark.conf.set(key, f"{SPLIT_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(key, held)
