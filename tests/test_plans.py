"""Physical-plan properties that must hold for every registered query."""

import re

import pytest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    from aurum.plans.registry import QUERIES
    out = {}   # the warehouse's rows come out of a Python data source by design
    for name, fn in QUERIES.items():
        if name in ("feature_clusters", "risk_model"):   # fitted models, not one plan
            continue
        df = fn(spark, SF)
        df.write.format("noop").mode("overwrite").save()   # final (adaptive) plan
        out[name] = _plan(df)
    return out


# the vector search scores pairs of blocks with one matrix product by design (see operators.vectors)
PYTHON_BY_DESIGN = {q: ("BatchEvalPython", "PythonUDF") for q in (
    "vector_top_k", "vector_top_k_filtered", "vector_neighbours", "vector_neighbours_by_label", "vector_index_neighbours")}


def test_no_cross_joins_and_no_python_in_any_plan(plans):
    bad = {n: [f for f in FORBIDDEN if f in p and f not in PYTHON_BY_DESIGN.get(n, ())]
           for n, p in plans.items()}
    assert not {n: f for n, f in bad.items() if f}


def test_latest_per_key_is_limited_before_the_shuffle(plans):
    for name in ("dedupe_latest", "vector_top_k", "document_upsert", "upsert_latest_wins"):
        p = plans[name]
        assert re.search(r"WindowGroupLimit .*Partial", p), name
        # the partial limit sits below (i.e. before) the exchange
        assert p.index("Exchange hashpartitioning") < p.rindex("Partial"), name


def test_filters_and_columns_reach_the_scan(plans):
    p = plans["extract_bounded"]
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "Limit" not in p and "TakeOrdered" not in p          # the whole year
    # the top-k rows are checkpointed once: the fact is not scanned again for the name lookup
    assert "fato_indicador" not in plans["closest_to_target"]
    p = plans["metas_extract"]
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double>" in p


def test_replay_prunes_batches(plans):
    assert re.search(r"PartitionFilters: \[.*_batch_id", plans["replay_as_of_batch"])


def test_aggregations_are_partial_before_the_shuffle(plans):
    for name in ("metas_extract", "quality_scorecard", "timeliness", "target_by_region", "state_ranking"):
        p = plans[name]
        assert re.search(r"functions=\[[^\]]*partial_(sum|count|avg|min|max)", p), name


def test_closest_to_target_filter_reaches_the_scan(spark):
    from aurum.plans.registry import _gold
    from pyspark.sql import functions as F
    fact = _gold(spark, SF, "fato_indicador_alfabetizacao")
    p = _plan(fact.where(F.col("gap_proficiencia").between(0.0, 50.0)).select("id_municipio"))
    assert "GreaterThanOrEqual(gap_proficiencia,0.0)" in p and "ReadSchema: struct<id_municipio:string" in p


def test_small_directories_are_broadcast(plans):
    assert "BroadcastHashJoin" in plans["enrich_directories"]
    assert "BroadcastHashJoin" in plans["consistency_rule"]


def test_hot_key_is_cut_to_one_row_per_task_before_the_exchange(spark):
    """A key holding a third of the rows reaches the shuffle as one row per map task."""
    from pyspark.sql import functions as F
    from aurum.operators.dedupe import latest_per_key
    n = 30_000
    df = (spark.range(n).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
          .withColumn("v", F.col("id") * 7 % 1000).repartition(8))
    out = latest_per_key(df, ["k"], ["v"])
    assert out.count() == 1 + (n - n // 3)
    hot = out.where("k = -1").first()
    assert hot.v == 999                                    # the maximum v among the hot key's rows
    m = re.search(r"WindowGroupLimit .*Partial", _plan(out))
    assert m is not None


def test_hot_key_in_a_shuffle_join_is_split_by_aqe(spark):
    """A directory too large to broadcast, a fact key holding a third of the rows: AQE splits it."""
    from pyspark.sql import functions as F
    from aurum.operators.joins import join_directory
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"), "id")
        directory = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("name-"), F.col("id")).alias("name"))
        out = join_directory(fact, directory, "k", max_rows=10)
        rows = out.collect()   # runs this Dataset's own plan, so its final adaptive plan can be read
        assert len(rows) == n and all(r.name is not None for r in rows)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
