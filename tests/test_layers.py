"""End-to-end: fixture sources -> bronze -> silver/quarantine -> gold, with metrics."""

from aurum import config as C
from aurum.plans import layers as L
from tests import fixtures as FX


def test_layered_run_on_the_fixture(spark, scratch):
    run = L.run(spark, FX.sources(spark), scratch, batch_id="20260830_120000")
    stages = {m["stage"]: m for m in run.metrics}
    silver = stages["bronze_to_silver"]
    assert (silver["rows_input"], silver["rows_clean"], silver["rows_quarantined"], silver["rows_duplicate"]) \
        == (8, 7, 1, 0)
    assert silver["quarantine_rate_pct"] == 12.5           # above 10: alert
    assert all(m["status"] == "SUCCESS" for m in run.metrics)
    q = run.quarantine.collect()
    assert len(q) == 1 and q[0].record_key == "5208707" and q[0].rejection_reason == C.REASON_ACCURACY
    assert '"indicador_alfabetizacao":104.5' in q[0].payload
    gold = run.gold
    assert gold["fato_indicador_alfabetizacao"].count() == 7
    assert gold["dim_uf"].count() == 6 and gold["dim_municipio"].count() == 7
    assert gold["dim_contexto_escolar"].where("localizacao_predominante = 'Urbana'").count() == 3
    sp = gold["fato_indicador_alfabetizacao"].where("id_municipio = '4106902'").first()
    assert sp.gap_proficiencia == -18.0 and sp.status_intervencao == "ADEQUADO"
    assert run.silver.where("nome_uf IS NULL OR regiao IS NULL").count() == 0


def test_rerun_of_the_same_batch_is_idempotent(spark, scratch):
    """a second ingestion of the directories must not multiply fact rows."""
    src = FX.sources(spark)
    L.run(spark, src, scratch, batch_id="20260830_120000")
    again = L.run(spark, src, scratch, batch_id="20260831_120000")   # a second, newer batch
    silver = {m["stage"]: m for m in again.metrics}["bronze_to_silver"]
    assert silver["rows_input"] == 16 and silver["rows_clean"] == 7 and silver["rows_duplicate"] == 7
    assert again.gold["fato_indicador_alfabetizacao"].count() == 7
    assert again.quarantine.count() == 2                    # one rejected row per delivered batch
    rerun = L.run(spark, src, scratch, batch_id="20260831_120000")  # same batch again: nothing doubles
    assert rerun.quarantine.count() == 2
    assert {m["stage"]: m for m in rerun.metrics}["bronze_to_silver"]["rows_input"] == 16


def test_metrics_balance_on_the_test_tables(spark):
    from aurum.plans import registry as R
    run = R.layers(spark, "/root/testdata/sf0.001")
    from aurum.operators.metrics import StageMetrics
    for m in run.metrics:
        sm = StageMetrics(**{k: m.get(k) for k in StageMetrics.__dataclass_fields__})
        assert sm.balanced() and sm.status == "SUCCESS"


def test_missing_required_bronze_fails_the_stage(spark, scratch):
    import pytest
    with pytest.raises(RuntimeError):
        L.to_silver(spark, scratch)


def test_gold_is_readable_from_sql(spark, scratch):
    run = L.run(spark, FX.sources(spark), scratch, batch_id="20260830_120000")
    for as_tables in (False, True):
        names = L.register_gold(spark, run, "gold_test" if as_tables else None, as_tables=as_tables)
        assert {n.rpartition(".")[2] for n in names} == set(run.gold)
        for name in names:
            plain = name.rpartition(".")[2]
            assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == run.gold[plain].count(), name
    for plain in run.gold:
        spark.catalog.dropTempView(plain)


def test_incremental_silver_merges_only_the_new_batch(spark, scratch):
    src = FX.sources(spark)
    first = L.run(spark, src, scratch, batch_id="20260830_120000", incremental=True, buckets=4)
    s1 = {m["stage"]: m for m in first.metrics}["bronze_to_silver"]
    assert (s1["rows_input"], s1["rows_clean"], s1["rows_quarantined"]) == (8, 7, 1)
    assert first.silver.count() == 7
    # the next delivery: PR revised, one new municipality, GO still out of range
    rows = [(2023, "PR", "4106902", 85.0, 84.0, 760.0), (2023, "AL", "2704302", 80.0, 70.0, 700.0),
            (2023, "GO", "5208707", 82.0, 115.0, 740.0)]
    src2 = dict(src, metas_municipio=FX.metas(spark, rows))
    second = L.run(spark, src2, scratch, batch_id="20260831_120000", incremental=True, buckets=4)
    s2 = {m["stage"]: m for m in second.metrics}["bronze_to_silver"]
    assert (s2["rows_input"], s2["rows_clean"], s2["rows_quarantined"]) == (3, 2, 1)
    silver = {r.id_municipio: r.media_proficiencia_saeb for r in second.silver.collect()}
    assert len(silver) == 8 and silver["4106902"] == 760.0 and silver["2704302"] == 700.0
    assert second.gold["fato_indicador_alfabetizacao"].count() == 8
    assert second.quarantine.count() == 2          # one per batch
    again = L.run(spark, src2, scratch, batch_id="20260831_120000", incremental=True, buckets=4)
    assert again.silver.count() == 8 and again.quarantine.count() == 2
    # the same batch re-delivered corrected (GO now in range): its old reject is gone
    fixed = [r if r[2] != "5208707" else (2023, "GO", "5208707", 82.0, 95.0, 740.0) for r in rows]
    src2b = dict(src, metas_municipio=FX.metas(spark, fixed))
    again = L.run(spark, src2b, scratch, batch_id="20260831_120000", incremental=True, buckets=4)
    s2b = {m["stage"]: m for m in again.metrics}["bronze_to_silver"]
    assert (s2b["rows_input"], s2b["rows_clean"], s2b["rows_quarantined"]) == (3, 3, 0)
    assert again.quarantine.count() == 1 and again.silver.count() == 9
    # a batch of another year rewrites only that year's fact partition
    src3 = dict(src, metas_municipio=FX.metas(spark, [(2024, "PR", "4106902", 86.0, 85.0, 765.0)]))
    third = L.run(spark, src3, scratch, batch_id="20260901_120000", incremental=True, buckets=4)
    fact = third.gold["fato_indicador_alfabetizacao"]
    assert fact.where("ano = 2023").count() == 9 and fact.where("ano = 2024").count() == 1
    assert {r.ano for r in third.gold["dim_tempo"].collect()} == {2023, 2024}
    dim = third.gold["dim_municipio"]
    assert dim.count() == 9 and set(dim.columns) == {"id_municipio", "sigla_uf", "nome_municipio", "regiao"}
    assert third.gold["dim_uf"].count() == 8                  # the fixture's six states, GO and AL


def test_stream_rows_pass_the_contract_and_newer_measurements_win(spark, scratch):
    import json
    from aurum.streaming import events as S
    good = {"event_id": "e1", "id_municipio": "4106902", "sigla_uf": "PR", "ano": 2023,
            "media_proficiencia_saeb": 770.0, "indicador_alfabetizacao": 84.0, "total_alunos_avaliados": 120,
            "timestamp_medicao": "2026-08-30T10:00:00"}
    new_key = dict(good, event_id="e2", id_municipio="2704302", sigla_uf="al")
    bad = dict(good, event_id="e3", id_municipio="2611606", sigla_uf="PE",
               media_proficiencia_saeb=-50.0, indicador_alfabetizacao=120.0)
    msgs = [json.dumps(good), json.dumps(new_key), json.dumps(bad), "{broken"]
    raw = spark.createDataFrame([(m,) for m in msgs], "value string")
    S.with_stream_lineage(S.parse_payload(raw), "topic").write.parquet(f"{scratch}/bronze/medicoes_stream")

    run = L.run(spark, FX.sources(spark), scratch, batch_id="20200101_000000",
                ingested_at="2020-01-01T00:00:00+00:00")   # the batch landed before the events
    silver = {r.id_municipio: r for r in run.silver.collect()}
    assert silver["4106902"].media_proficiencia_saeb == 770.0          # stream is newer than the batch
    assert silver["4106902"].total_alunos_avaliados == 120
    assert silver["4106902"].meta_alfabetizacao == 70.0                # the batch target is kept
    assert silver["2704302"].sigla_uf == "AL" and silver["2704302"].meta_alfabetizacao is None
    assert silver["2611606"].media_proficiencia_saeb == 770.5          # rejected event changes nothing
    reasons = {(r.source, r.rejection_reason) for r in run.quarantine.collect()}
    assert ("medicoes_stream", C.REASON_ACCURACY) in reasons and ("medicoes_stream", C.REASON_MALFORMED) in reasons
    assert ("metas_municipio", C.REASON_ACCURACY) in reasons
    fact = run.gold["fato_indicador_alfabetizacao"]
    assert "total_alunos_avaliados" in fact.columns and fact.count() == 8
    assert spark.read.parquet(f"{scratch}/silver/fato_medicoes_stream").count() == 2
    m = {x["stage"]: x for x in run.metrics}["bronze_to_silver"]
    assert (m["rows_input"], m["rows_clean"], m["rows_quarantined"], m["rows_duplicate"]) == (8, 7, 1, 0)


def _stages(run):
    return {m["stage"]: m for m in run.metrics}


def test_runs_without_a_rejected_row_finish(spark, scratch):
    good = FX.metas(spark, [r for r in FX.METAS_ROWS if r[4] <= 100.0])
    src = dict(FX.sources(spark), metas_municipio=good)
    for incremental in (False, True):
        run = L.run(spark, src, f"{scratch}/{incremental}", batch_id="20260830_120000", incremental=incremental)
        assert _stages(run)["bronze_to_silver"]["rows_quarantined"] == 0
        assert run.quarantine.count() == 0 and "rejection_reason" in run.quarantine.columns
        assert run.gold["fato_indicador_alfabetizacao"].count() == 7


def test_a_root_keeps_its_mode(spark, scratch):
    import pytest
    L.run(spark, FX.sources(spark), scratch, batch_id="20260830_120000")
    with pytest.raises(ValueError, match="full"):
        L.run(spark, FX.sources(spark), scratch, batch_id="20260831_120000", incremental=True)


def test_a_missing_required_source_stops_the_run(spark, scratch):
    import pytest
    with pytest.raises(RuntimeError, match="metas_municipio"):
        L.run(spark, dict(FX.sources(spark), metas_municipio=None), scratch)


def test_two_deliveries_give_the_gold_of_the_latest(spark, scratch):
    def levels(rate):
        return {"metas_uf": spark.createDataFrame([(2023, "PR", rate, 70.0, 750.0)], "ano int, sigla_uf string, "
                    "indicador_alfabetizacao double, meta_alfabetizacao double, media_proficiencia_saeb double"),
                "metas_brasil": spark.createDataFrame([(2023, rate, 70.0, 750.0)], "ano int, "
                    "indicador_alfabetizacao double, meta_alfabetizacao double, media_proficiencia_saeb double")}

    src = FX.sources(spark)
    once = L.run(spark, {**src, **levels(66.0)}, f"{scratch}/once", batch_id="20260830_120000")
    L.run(spark, {**src, **levels(60.0)}, f"{scratch}/twice", batch_id="20260829_120000",
          ingested_at="2026-08-29T12:00:00+00:00")
    twice = L.run(spark, {**src, **levels(66.0)}, f"{scratch}/twice", batch_id="20260830_120000",
                  ingested_at="2026-08-30T12:00:00+00:00")
    for name in ("fato_metas_uf", "fato_metas_brasil", "dim_contexto_escolar"):
        rows = [sorted(map(tuple, r.gold[name].collect()), key=str) for r in (once, twice)]
        assert rows[0] == rows[1], name


def test_long_ids_stay_distinct_and_balance(spark, scratch):
    """Ids of more digits than the contract's are quarantined whole, census rows too; none are merged."""
    rows = [(2023, "PR", i, 70.0, 73.5, 761.0) for i in ("1000000", "10000001", "10000002")]
    census = spark.createDataFrame([(i, "PR", 2023, f"E{i}", "Urbana") for _, _, i, *_ in rows],
                                   "id_municipio string, sigla_uf string, ano int, id_escola string, localizacao string")
    run = L.run(spark, dict(FX.sources(spark), metas_municipio=FX.metas(spark, rows), censo_escolar=census), scratch,
                batch_id="20260830_120000")
    m = _stages(run)["bronze_to_silver"]
    assert (m["rows_input"], m["rows_clean"], m["rows_quarantined"]) == (3, 1, 2)
    keys = sorted((r.source, r.record_key) for r in spark.read.parquet(f"{scratch}/silver/quarantine").collect())
    assert keys == [(s, k) for s in ("censo_escolar", "metas_municipio") for k in ("10000001", "10000002")]
    assert [r.id_municipio for r in run.gold["dim_contexto_escolar"].collect()] == ["1000000"]
    from aurum.functions.normalize import pad_id
    from pyspark.sql import functions as F
    ids = spark.range(1).select(*[pad_id(F.lit(i)).alias(f"c{i}") for i in (7, 10000001, 10000002)]).first()
    assert tuple(ids) == ("0000007", "10000001", "10000002")


def test_incremental_runs_merge_the_stream(spark, scratch):
    import json
    from aurum.streaming import events as S
    event = {"event_id": "e1", "id_municipio": "4106902", "sigla_uf": "PR", "ano": 2023,
             "media_proficiencia_saeb": 770.0, "indicador_alfabetizacao": 84.0, "total_alunos_avaliados": 120,
             "timestamp_medicao": "2026-08-30T10:00:00"}
    raw = spark.createDataFrame([(json.dumps(event),), ("{broken",)], "value string")
    S.with_stream_lineage(S.parse_payload(raw), "topic").write.parquet(f"{scratch}/bronze/medicoes_stream")
    run = L.run(spark, FX.sources(spark), scratch, batch_id="20200101_000000", incremental=True, buckets=4,
                ingested_at="2020-01-01T00:00:00+00:00")
    row = run.silver.where("id_municipio = '4106902'").first()
    assert row.media_proficiencia_saeb == 770.0 and row.meta_alfabetizacao == 70.0
    assert run.silver.count() == 7
    fact = run.gold["fato_indicador_alfabetizacao"].where("id_municipio = '4106902'").first()
    assert fact.media_proficiencia_saeb == 770.0


def test_a_rerun_without_rejects_leaves_none_behind(spark, scratch):
    src = FX.sources(spark)
    assert L.run(spark, src, scratch, batch_id="20260830_120000").quarantine.count() == 1
    good = FX.metas(spark, [r for r in FX.METAS_ROWS if r[4] <= 100.0])
    again = L.run(spark, dict(src, metas_municipio=good), scratch, batch_id="20260830_120000")
    assert again.quarantine.count() == 0
