import pytest
from pyspark.sql import functions as F

from aurum.sinks.projections import kv_projection
from aurum.sinks.writers import overwrite_partitions, write_bronze, write_split, write_table
from aurum.sources.catalog import register_external
from aurum.sources.lineage import as_of_batch, make_batch_id, with_file_lineage, with_lineage
from aurum.sources.readers import (
    SourceSpec, csv_reader, extract, parquet_reader, query_reader, read_bronze,
    read_first_available, read_inputs,
)


def test_batch_id_format():
    import datetime as dt
    assert make_batch_id(dt.datetime(2026, 8, 30, 12, 0, 0)) == "20260830_120000"


def test_lineage_columns(spark):
    df = spark.createDataFrame([("4106902", 2023)], "id_municipio string, ano int")
    r = with_lineage(df, "test_source", "20260830_120000").first()
    assert r._source_table == "test_source" and r._batch_id == "20260830_120000"
    assert r._ingestion_timestamp.endswith("+00:00")


def test_csv_fallback_all_strings_and_fallthrough(spark, scratch):
    df = spark.createDataFrame([(1, "a", 2.5)], "k int, s string, x double")
    df.write.option("header", True).csv(f"{scratch}/csv")
    readers = [query_reader("jdbc", url="jdbc:unavailable://x", query="select 1"),
               parquet_reader(f"{scratch}/missing"),
               csv_reader(f"{scratch}/csv", ["k", "s", "x"])]
    got, which = read_first_available(spark, readers)
    assert which == 2
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["string"] * 3
    assert tuple(got.first()) == ("1", "a", "2.5")


def test_empty_sources_are_skipped_and_required_ones_raise(spark, scratch):
    spark.createDataFrame([], "k int").write.parquet(f"{scratch}/empty")
    out = read_inputs(spark, [SourceSpec("opt", [parquet_reader(f"{scratch}/empty")])])
    assert out["opt"] is None
    with pytest.raises(RuntimeError):
        read_inputs(spark, [SourceSpec("req", [parquet_reader(f"{scratch}/nope")], required=True)])


def test_bronze_batches_replay_and_rerun(spark, scratch):
    path = f"{scratch}/bronze"
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert read_bronze(spark, path) is None
    assert write_bronze(df, path, "20240101_000000")
    assert write_bronze(df.union(spark.createDataFrame([(3,)], "k int")), path, "20240102_000000")
    assert write_bronze(df, path, "20240101_000000")       # rerun of a batch replaces it
    b = read_bronze(spark, path)
    assert b.count() == 5
    assert as_of_batch(b, "20240101_000000").count() == 2
    plan = as_of_batch(b, "20240101_000000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_batch_id" in plan
    assert with_file_lineage(b).where(F.col("_source_file").isNull()).count() == 0


def test_failed_bronze_write_returns_false(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert write_bronze(df, "unknownscheme://nowhere/x", "b") is False


def test_extract_bounded_is_ordered_and_pruned(spark, scratch):
    spark.range(100).selectExpr("id", "id % 3 AS g", "cast(id AS string) AS s").write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    out = extract(t, {"key": "id", "grp": "g"}, where=F.col("g") == 1, order_by=["key"], limit=5)
    assert [r.key for r in out.collect()] == [1, 4, 7, 10, 13]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(g), EqualTo(g,1)]" in plan and "ReadSchema: struct<id:bigint,g:bigint>" in plan


def test_partition_overwrite_is_idempotent(spark, scratch):
    path = f"{scratch}/p"
    base = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "a"), (3, 2022, "a")], "k int, y int, s string")
    write_table(base, path, partition_by=["y"])
    fix = spark.createDataFrame([(2, 2021, "b")], "k int, y int, s string")
    for _ in range(2):
        overwrite_partitions(fix, path, ["y"])
        got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "y", "s").collect())
        assert got == [(1, 2020, "a"), (2, 2021, "b"), (3, 2022, "a")]


def test_write_split_single_pass(spark, scratch):
    df = spark.createDataFrame([(1, None), (2, "bad")], "k int, rejection_reason string")
    write_split(df, f"{scratch}/split")
    back = spark.read.parquet(f"{scratch}/split")
    assert back.where("_outcome = 'clean'").count() == 1 and back.where("_outcome = 'quarantine'").count() == 1


def test_external_table_discovers_partitions(spark, scratch):
    path = f"{scratch}/ext"
    write_table(spark.createDataFrame([(1, 2020), (2, 2021)], "k int, y int"), path, partition_by=["y"])
    t = register_external(spark, "ext_test_table", path, partitioned=True)
    assert sorted(tuple(r) for r in t.collect()) == [(1, 2020), (2, 2021)]
    assert t.where("y = 2021").count() == 1


def test_kv_projection_format(spark):
    df = spark.createDataFrame([("4106902", 2023, 85.0, 82.4, "PARCIAL"), ("1", 2024, None, 1.005, None)],
                               "id_municipio string, ano int, meta_oficial double, indicador_real double, "
                               "status_cumprimento string")
    got = {r.key: r.value for r in kv_projection(df).collect()}
    assert got["kpi:municipio:4106902:ano:2023"] == '{"taxa": 82.40, "meta": 85.00, "status": "PARCIAL"}'
    assert got["kpi:municipio:1:ano:2024"] == '{"taxa": 1.01, "meta": null, "status": null}'


def test_batch_id_is_utc_whatever_the_session_zone(spark):
    from aurum.sources.lineage import batch_id_of
    df = spark.createDataFrame([("2024-01-01T00:00:00+00:00",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(batch_id_of(F.to_timestamp("s")).alias("b")).first().b == "20240101_000000", tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_broadcast_only_behind_a_size_bound(spark):
    from aurum.operators.joins import broadcast_row_bound, maybe_broadcast, row_width
    small = spark.range(10).selectExpr("id", "cast(id as string) AS s")
    big = spark.range(5000).selectExpr("id", "cast(id as string) AS s")
    assert row_width(small.schema) == 16 + 8 + 64
    assert broadcast_row_bound(big, max_rows=10**6, max_bytes=88 * 100) == 100
    fact = spark.range(100).withColumnRenamed("id", "k")

    def plan(d):
        return fact.join(d.withColumnRenamed("id", "k"), "k", "left")._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(maybe_broadcast(small, max_rows=100))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(maybe_broadcast(big, max_rows=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_merge_refuses_another_bucket_count_and_an_unreadable_table(spark, scratch):
    import glob
    import pytest
    from aurum.operators.merge import merge_into_buckets
    table = f"{scratch}/merged"
    rows = spark.range(100).selectExpr("id AS k", "1 AS ts", "0 AS v")
    assert merge_into_buckets(rows, table, ["k"], ["ts"], buckets=4) == 4
    change = rows.where("k = 7").selectExpr("k", "2 AS ts", "9 AS v")
    with pytest.raises(ValueError, match="4 buckets"):
        merge_into_buckets(change, table, ["k"], ["ts"], buckets=8)
    merge_into_buckets(change, table, ["k"], ["ts"], buckets=4)
    back = spark.read.parquet(table)
    assert back.count() == 100 and [r.v for r in back.where("k = 7").collect()] == [9]
    local = table.removeprefix("file:")
    for f in glob.glob(f"{local}/**/*.parquet", recursive=True):
        with open(f, "wb") as out:
            out.write(b"not a footer")
    with pytest.raises(Exception):
        merge_into_buckets(change, table, ["k"], ["ts"], buckets=4)
    assert len(glob.glob(f"{local}/**/*.parquet", recursive=True)) >= 4      # nothing was replaced


def test_no_machine_local_folder_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from aurum.session import shared_root
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))


def test_a_callers_limit_is_ordered(spark):
    from aurum.sources.readers import extract
    df = spark.range(50).selectExpr("49 - id AS k", "id % 2 AS odd").repartition(4)
    got = extract(df, {"n": "k"}, where=df["odd"] == 1, order_by=["n"], limit=3)
    assert [r.n for r in got.collect()] == [0, 2, 4]
    assert extract(df, {"n": "k"}).count() == 50
