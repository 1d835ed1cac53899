"""Mergeable lag sketches against exact percentiles, and directories as of a batch."""

import math
import random

from pyspark.sql import functions as F

from aurum.operators import quality as Q
from aurum.operators.joins import join_as_of
from aurum.plans import layers as L
from tests import fixtures as FX


def test_percentiles_of_merged_sketches_are_near_the_exact_ones(spark):
    rng = random.Random(7)
    rows = [("a", int(math.exp(rng.uniform(0, 14)))) for _ in range(3000)] + [("b", rng.randrange(-5000, 60)) for _ in range(1000)] + \
        [("c", 0)] * 5 + [("d", None)]
    df = spark.createDataFrame(rows, "kind string, lag long").withColumn("at", F.lit("2024-01-01").cast("timestamp_ntz")) \
        .withColumn("landed", F.col("at") + F.make_dt_interval(secs=F.col("lag").cast("decimal(18,6)")))
    whole = Q.lag_sketch(df, "at", "landed", ["kind"])
    parts = None
    for i in range(4):
        part = Q.lag_sketch(df.where(F.pmod(F.xxhash64("lag"), F.lit(4)) == i), "at", "landed", ["kind"])
        parts = part if parts is None else parts.unionByName(part)
    merged = Q.merge_sketches(parts, ["kind"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))     # any split gives the same sketch
    assert whole.where("kind = 'a'").count() <= 64 + 32 * (21 - 6)                        # lags below 2^21
    got = {r.kind: r for r in Q.sketch_percentiles(merged, ["kind"], (0.1, 0.5, 0.95, 0.99)).collect()}
    assert set(got) == {"a", "b", "c"}
    for kind in got:
        lags = sorted(lag for k, lag in rows if k == kind and lag is not None)
        assert got[kind].n_events == len(lags)
        for p in (10, 50, 95, 99):
            exact = lags[math.ceil(len(lags) * p / 100) - 1]
            near = got[kind][f"p{p}_s"]
            assert abs(near) <= abs(exact) and abs(exact) - abs(near) <= abs(exact) / 32, (kind, p)
            assert abs(exact) >= 64 or near == exact


def test_rows_take_the_directory_row_of_their_version(spark):
    facts = spark.createDataFrame([("k", v) for v in "0123459"] + [("other", "3"), (None, "3"), ("k", None)], "id string, at string")
    versions = spark.createDataFrame([("k", "1", "one"), ("k", "3", "three"), ("k", "3", "a three before"), ("k", "5", "five"), ("x", "1", "x")],
                                     "id string, v string, name string")
    got = sorted(((r.id, r["at"]), r.name) for r in join_as_of(facts, versions, "id", "at", "v", ["name"]).where("id = 'k' AND at IS NOT NULL")
                 .withColumnRenamed("name", "found").select("id", "at", F.col("found").alias("name")).collect())
    assert [n for _, n in got] == [None, "one", "one", "three", "three", "five", "five"]
    assert join_as_of(facts, versions, "id", "at", "v", ["name"]).count() == facts.count()


def test_a_replay_sees_the_directories_of_its_batch(spark, scratch):
    src = FX.sources(spark)
    L.ingest(spark, src, scratch, "20260901_000000", "2026-09-01T00:00:00+00:00")
    renamed = spark.createDataFrame([(i, f"New {n}", g) for i, n, g in FX.MUNICIPIOS], "id_municipio string, nome_municipio string, sigla_uf string")
    moved = spark.createDataFrame([(g, n, "Moved") for g, n, _ in FX.UFS], "sigla_uf string, nome_uf string, regiao string")
    later = dict(src, municipios=renamed, ufs=moved, metas_municipio=FX.metas(spark, [(2024, "PR", "4106902", 71.0, 75.0, 765.0)]))
    L.ingest(spark, later, scratch, "20260902_000000", "2026-09-02T00:00:00+00:00")
    old = {(r.id_municipio, r.ano): r for r in L.replay(spark, scratch, "20260901_000000").collect()}
    assert len(old) == 7 and old["4106902", 2023].nome_municipio == "Municipio 4106902" and old["4106902", 2023].regiao == "Sul"
    new = {(r.id_municipio, r.ano): r for r in L.replay(spark, scratch, "20260902_000000").collect()}
    assert len(new) == 8 and new["4106902", 2024].nome_municipio == "New Municipio 4106902" and new["4106902", 2024].regiao == "Moved"
    assert new["4106902", 2023].nome_municipio == "Municipio 4106902"        # a row of the first batch
