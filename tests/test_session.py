import pyspark
import pytest

from aurum import session as SS


def test_spark_major_version():
    assert pyspark.__version__.startswith("4.")


def test_shared_path_is_under_the_checkpoint_folder(spark):
    root = SS.shared_root(spark)
    p1, p2 = SS.shared_path(spark, "a", "b"), SS.shared_path(spark, "a", "b")
    assert p1.startswith(root + "/aurum/a/b/") and p1 != p2
    assert SS.shared_path(spark, "x", unique=False) == root + "/aurum/x"


def test_scale_conf_sizes_partitions_by_volume():
    c = SS.scale_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 819_200
    assert SS.scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


KEYS = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.files.maxPartitionBytes")


@pytest.fixture()
def own(spark):
    """A session with settings of its own."""
    session = spark.newSession()
    for key in KEYS:
        session.conf.unset(key)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


def test_shuffles_start_with_partitions_for_the_rows_and_never_fewer(own):
    SS.size_shuffles(own, 4 * SS.ROWS_PER_PARTITION)
    assert own.conf.get(KEYS[0], None) in (None, "None")
    SS.size_shuffles(own, 40 * SS.ROWS_PER_PARTITION + 1)
    assert own.conf.get(KEYS[0]) == "41" and own.conf.get("spark.sql.shuffle.partitions") == "4"
    assert SS._bytes(own.conf.get(KEYS[1])) == SS.MERGED_BYTES
    SS.size_shuffles(own, 1)
    assert own.conf.get(KEYS[0]) == "41"
    assert [SS._bytes(x) for x in ("64m", "67108864b", "4096", "1g", "16MB")] == [64 << 20, 64 << 20, 4096, 1 << 30, 16 << 20]


def test_arrow_batches_are_only_made_smaller(own):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for held, want in (("64m", SS.BATCH_BYTES), ("4m", 4 << 20)):
        own.conf.set(key, held)
        SS.small_batches(own)
        assert SS._bytes(own.conf.get(key)) == want


def test_small_splits_hold_inside_only(own):
    before = own.conf.get(KEYS[2])
    with pytest.raises(KeyError):
        with SS.small_splits(own):
            assert SS._bytes(own.conf.get(KEYS[2])) == SS.SPLIT_BYTES
            raise KeyError
    assert own.conf.get(KEYS[2]) == before


def test_a_task_sorts_no_more_rows_when_the_tables_grow(own, scratch, monkeypatch):
    """With four partitions set, each would hold a quarter of the rows of whatever is read."""
    from aurum.operators.dedupe import latest_delivery
    from aurum.plans import mapping as MP
    monkeypatch.setattr(SS, "ROWS_PER_PARTITION", 500)
    monkeypatch.setattr(SS, "MERGED_BYTES", 1 << 10)
    own.conf.set(KEYS[1], "64k")
    own.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    most = []
    for n in (2_000, 20_000):
        own.range(n).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id % 7 AS l_quantity").write.parquet(f"{scratch}/{n}/lineitem.parquet")
        rows = MP.load_tables(own, f"{scratch}/{n}")["lineitem"]
        latest = latest_delivery(rows, ["l_orderkey"], ["l_quantity"])
        most.append(latest.groupBy(spark_partition()).count().agg({"count": "max"}).first()[0])
    assert most[1] <= 2 * most[0]


def spark_partition():
    from pyspark.sql import functions as F
    return F.spark_partition_id().alias("p")


def test_defaults_turn_on_aqe_and_utc():
    assert SS.DEFAULTS["spark.sql.adaptive.enabled"] == "true"
    assert SS.DEFAULTS["spark.sql.session.timeZone"] == "UTC"
    assert SS.DEFAULTS["spark.ui.enabled"] == "false"


def test_a_failing_stage_stops_the_run_and_is_logged(spark, scratch):
    from aurum.plans import layers as L
    from tests import fixtures as FX
    seen = []
    src = {k: v for k, v in FX.sources(spark).items() if k != "metas_municipio"}
    with pytest.raises(RuntimeError, match="metas_municipio"):
        L.run(spark, src, scratch, batch_id="20260830_120000", sink=seen.append)
    assert [(m["stage"], m["status"]) for m in seen] == [("batch_ingestion", "ERROR")]
