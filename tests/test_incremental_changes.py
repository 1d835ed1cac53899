"""Incremental runs read the new files of the stream and the new batch of the census only, and give the gold of a full run."""

import json

from pyspark.sql import functions as F

from aurum import config as C
from aurum.plans import layers as L
from aurum.streaming import events as S
from tests import fixtures as FX


def _event(i, entity, score, group="PR", year=2023):
    return json.dumps({"event_id": f"e{i}", "id_municipio": entity, "sigla_uf": group, "ano": year,
                       "media_proficiencia_saeb": score, "indicador_alfabetizacao": 84.0, "total_alunos_avaliados": 100 + i,
                       "timestamp_medicao": f"2026-08-30T10:00:0{i}"})


def _deliver(spark, root, messages, at):
    raw = spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1)
    S.with_stream_lineage(S.parse_payload(raw), "topic").withColumn("_ingestion_timestamp", F.lit(at).cast("timestamp")) \
        .write.mode("append").parquet(f"{root}/bronze/medicoes_stream")


def _census(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'ano' else 'string'}" for c in FX.CENSUS_COLS))


SCORES = ("id_municipio", "ano", "media_proficiencia_saeb", "indicador_alfabetizacao", "total_alunos_avaliados")


def _gold(run):
    fact = run.gold["fato_indicador_alfabetizacao"]
    context = run.gold["dim_contexto_escolar"]
    return (sorted(map(tuple, fact.select(*[c for c in SCORES if c in fact.columns]).collect()), key=str),
            sorted(map(tuple, context.select(*sorted(context.columns)).collect()), key=str))


def test_runs_take_new_files_only_and_match_a_full_run(spark, scratch):
    inc, full = f"{scratch}/inc", f"{scratch}/full"
    first = dict(FX.sources(spark))
    moved = [("4106902", "PR", 2023, "E1", "Rural", "Municipal"), ("12345678", "SC", 2023, "E2", "Rural", "Municipal"),
             ("4205407", "SC", 2023, "E9", "Urbana", "Estadual")]
    second = dict(first, censo_escolar=_census(spark, moved),
                  metas_municipio=FX.metas(spark, [(2023, "SC", "4205407", 64.0, 61.0, 735.0), (2024, "PR", "4106902", 71.0, 75.0, 765.0)]))
    one = [_event(1, "4106902", 770.0), _event(2, "4205407", 700.0, "SC"), "{broken"]
    two = [_event(3, "4106902", 775.0), _event(4, "9900001", 600.0, "SC"), _event(5, "4205407", 5000.0, "SC")]
    runs = []
    for root, incremental in ((inc, True), (full, False)):
        _deliver(spark, root, one, "2026-09-10 00:00:00")
        a = L.run(spark, first, root, batch_id="20260901_000000", incremental=incremental, buckets=4,
                  ingested_at="2026-09-01T00:00:00+00:00")
        gold_a = _gold(a)
        _deliver(spark, root, two, "2026-09-11 00:00:00")
        b = L.run(spark, second, root, batch_id="20260902_000000", incremental=incremental, buckets=4,
                  ingested_at="2026-09-02T00:00:00+00:00")
        runs.append((gold_a, _gold(b), a, b))
    (inc_a, inc_b, first_run, second_run), (full_a, full_b, _, full_run) = runs
    assert inc_a == full_a
    assert inc_b == full_b
    reasons = {(r.source, r.rejection_reason) for r in second_run.quarantine.collect()}
    assert ("medicoes_stream", C.REASON_ACCURACY) in reasons and ("medicoes_stream", C.REASON_MALFORMED) in reasons
    assert ("censo_escolar", C.REASON_VALIDITY) in reasons
    # the checkpoint names each bronze file once
    log = spark.read.text(f"{inc}/silver/_stream_checkpoint/sources/0").where("value LIKE '{%'")
    files = [json.loads(r.value)["path"] for r in log.collect()]
    assert len(files) == len(set(files)) == 2
    assert spark.read.parquet(f"{inc}/silver/_contract_stream_inc/_epoch=1").count() == 3
    plan = spark.read.parquet(f"{inc}/bronze/censo_escolar").where(F.col("_batch_id") == "20260902_000000") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch_id" in plan
    # a batch delivered again changes nothing and takes no stream file again
    report = L.to_silver_incremental(spark, inc, "20260902_000000", buckets=4)
    assert report["stream_rows_input"] == 0 and report["rows_input"] == 2
    assert report["census_rows_input"] == 3 and report["census_rows_quarantined"] == 1       # the batch's rows only
    again = L.run(spark, second, inc, batch_id="20260902_000000", incremental=True, buckets=4,
                  ingested_at="2026-09-02T00:00:00+00:00")
    assert _gold(again) == inc_b
