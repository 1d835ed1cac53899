from pyspark.sql import functions as F

from aurum import config as C
from aurum.config import LITERACY
from aurum.operators import analytics as A
from aurum.operators import gold as G
from aurum.operators import quality as Q
from aurum.operators.joins import join_directory
from tests import fixtures as FX


def silver(spark):
    clean, _ = Q.split(FX.metas(spark))
    src = FX.sources(spark)
    out = join_directory(clean, src["municipios"].select("id_municipio", "nome_municipio"), "id_municipio")
    return join_directory(out, src["ufs"], "sigla_uf")


def test_dim_time_decade_and_period(spark):
    df = spark.createDataFrame([(2024,), (2028,), (2021,), (None,)], "ano int")
    got = {r.ano: (r.decada, r.periodo_meta) for r in G.dim_time(df).collect()}
    assert got[2024] == ("2020", "2023-2026")
    assert got[2028] == ("2020", "2027-2030")
    assert got[2021] == ("2020", None)           # F9: outside both periods
    legacy = {r.ano: r.periodo_meta for r in G.dim_time(df, LITERACY.with_(null_safe_status=False)).collect()}
    assert legacy[2021] == "2027-2030"


def test_fact_cutoff_flag_gap_and_status(spark):
    df = spark.createDataFrame([("5103403", "MT", 2024, 801.0)],
                               "id_municipio string, sigla_uf string, ano int, media_proficiencia_saeb double")
    r = G.fact_indicator(df).first()
    assert r.atingiu_corte_alfabetizado is True and r.gap_proficiencia == -58.0
    assert r.status_intervencao == C.STATUS_ADEQUATE and r.nota_corte_saeb == 743.0


def test_fact_status_edges(spark):
    """rounded gap 0.0 -> ADEQUADO though below the cutoff; null score -> null status."""
    df = spark.createDataFrame([("1", "SP", 2024, 742.996), ("2", "SP", 2024, 692.996), ("3", "SP", 2024, None)],
                               "id_municipio string, sigla_uf string, ano int, media_proficiencia_saeb double")
    got = {r.id_municipio: (r.gap_proficiencia, r.atingiu_corte_alfabetizado, r.status_intervencao)
           for r in G.fact_indicator(df).collect()}
    assert got["1"] == (0.0, False, C.STATUS_ADEQUATE)
    assert got["2"] == (50.0, False, C.STATUS_ATTENTION)
    assert got["3"] == (None, None, None)


def test_fact_target_statuses_and_zero_target(spark):
    df = spark.createDataFrame([("a", "SP", 2024, 100.0, 105.0), ("b", "CE", 2024, 100.0, 95.0),
                                ("c", "AM", 2024, 100.0, 85.0), ("d", "AM", 2024, 0.0, 85.0),
                                ("e", "AM", 2024, 0.0, None)],
                               "id_municipio string, sigla_uf string, ano int, meta_alfabetizacao double, "
                               "indicador_alfabetizacao double")
    got = {r.id_municipio: (r.gap_percentual, r.status_cumprimento) for r in G.fact_target(df).collect()}
    assert got["a"][1] == C.STATUS_MET and got["b"][1] == C.STATUS_PARTIAL and got["c"][1] == C.STATUS_NOT_MET
    assert got["d"] == (None, C.STATUS_MET)        # F10: no division error, null gap
    assert got["e"] == (None, None)
    assert G.fact_target(df.drop("meta_alfabetizacao")) is None


def test_fixture_facts_match_goldens(spark):
    s = silver(spark)
    fi = {r.id_municipio: (r.sigla_uf, r.gap_proficiencia, r.atingiu_corte_alfabetizado, r.status_intervencao)
          for r in G.fact_indicator(s).collect()}
    ft = {r.id_municipio: (r.gap_percentual, r.status_cumprimento) for r in G.fact_target(s).collect()}
    golden = {
        "1501402": ("PA", 41.0, False, "ATENCAO", -15.0, "NAO_ATINGIDA"),
        "2111300": ("MA", 59.0, False, "CRITICO", -7.5, "PARCIAL"),
        "2609600": ("PE", -58.5, True, "ADEQUADO", 2.5, "ATINGIDA"),
        "2611606": ("PE", -27.5, True, "ADEQUADO", 12.0, "ATINGIDA"),
        "4106902": ("PR", -18.0, True, "ADEQUADO", 5.0, "ATINGIDA"),
        "4205407": ("SC", 12.0, False, "ATENCAO", -5.0, "PARCIAL"),
        "5002704": ("MS", -9.0, True, "ADEQUADO", -5.0, "PARCIAL"),
    }
    assert set(fi) == set(golden)
    for k, g in golden.items():
        assert fi[k] == g[:4] and ft[k] == g[4:]


def test_fixture_dimensions(spark):
    s = silver(spark)
    assert [tuple(r) for r in G.dim_time(s).collect()] == [(2023, "2020", "2023-2026")]
    assert G.dim_entity(s).count() == 7
    ufs = G.dim_group(s)
    assert ufs.count() == 6 and ufs.where("sigla_uf = 'GO'").count() == 0   # F14
    census = FX.sources(spark)["censo_escolar"]
    ctx = {r.id_municipio: (r.localizacao_predominante, r.taxa_infraestrutura_basica)
           for r in G.dim_context(census).collect()}
    assert ctx == {"4106902": ("Urbana", None), "4205407": ("Rural", None), "2611606": ("Urbana", None),
                   "2609600": ("Urbana", None), "1501402": ("Rural", None)}
    coded = census.withColumn("tp_localizacao", F.when(F.col("localizacao") == "Urbana", 1).otherwise(2))
    assert {r.localizacao_predominante for r in G.dim_context(coded.drop("localizacao")).collect()} == {"Urbana", "Rural"}
    assert G.empty_context(spark).count() == 0


def test_query1_state_ranking_golden(spark):
    out = [tuple(r) for r in A.state_ranking(G.fact_indicator(silver(spark))).collect()]
    hi, lo = C.POLICY_HIGH, C.POLICY_LOW
    assert out == [
        ("MA", 1, 684.0, 66.6, 0, 0.0, -59.0, hi),
        ("PA", 1, 702.0, 51.0, 0, 0.0, -41.0, hi),
        ("SC", 1, 731.0, 60.8, 0, 0.0, -12.0, hi),
        ("MS", 1, 752.0, 64.6, 1, 100.0, 9.0, lo),
        ("PR", 1, 761.0, 73.5, 1, 100.0, 18.0, lo),
        ("PE", 2, 786.0, 69.0, 2, 100.0, 43.0, lo),
    ]


def test_query2_yoy_single_year(spark):
    out = A.yoy_evolution(G.fact_indicator(silver(spark))).collect()
    assert len(out) == 6
    assert all(r.media_saeb_ano_anterior is None and r.variacao_saeb_yoy is None for r in out)


def test_query2_yoy_change(spark):
    df = spark.createDataFrame([("1", "SP", 2023, 700.0, 50.0), ("1", "SP", 2024, 710.555, 50.0)],
                               "id_municipio string, sigla_uf string, ano int, media_proficiencia_saeb double, "
                               "indicador_alfabetizacao double")
    out = A.yoy_evolution(G.fact_indicator(df)).collect()
    assert [(r.ano, r.media_saeb_ano_anterior, r.variacao_saeb_yoy) for r in out] == [
        (2023, None, None), (2024, 700.0, 10.56)]


def test_query3_closest_to_target(spark):
    s = silver(spark)
    out = A.closest_to_target(G.fact_indicator(s), G.dim_entity(s)).collect()
    assert [(r.sigla_uf, r.id_municipio, r.gap_para_corte) for r in out] == [
        ("SC", "4205407", 12.0), ("PA", "1501402", 41.0)]
    assert out[0].nome_municipio == "Municipio 4205407"


def test_query4_target_by_region_golden(spark):
    s = silver(spark)
    out = [tuple(r) for r in A.target_by_region(G.fact_target(s), G.dim_group(s)).collect()]
    assert out == [
        ("Centro-Oeste", 2023, 1, 68.0, 64.6, -5.0, 0, 1, 0, 0.0),
        ("Nordeste", 2023, 3, 67.33, 68.2, 2.33, 2, 1, 0, 66.67),
        ("Norte", 2023, 1, 60.0, 51.0, -15.0, 0, 0, 1, 0.0),
        ("Sul", 2023, 2, 67.0, 67.15, 0.0, 1, 1, 0, 50.0),
    ]


def test_rank_and_mean(spark):
    out = A.group_rank_and_mean(G.fact_indicator(silver(spark)))
    pe = out.where("sigla_uf = 'PE'").collect()
    assert {r.media_grupo for r in pe} == {786.0} and {r.rank_grupo for r in pe} == {1}
    assert sorted(r.desvio_media for r in pe) == [-15.5, 15.5]


def test_rounding_is_half_up_on_the_decimal_value(spark):
    from aurum.functions.rounding import round_half_up
    df = spark.createDataFrame([(1.005,), (0.285,), (2.675,), (-1.005,), (2.6749999999,), (49.9949999999,)], "x double")
    rounded = df.select(round_half_up("x").alias("y"), F.round("x", 2).alias("spark")).collect()
    assert [r.y for r in rounded] == [1.01, 0.29, 2.68, -1.01, 2.67, 49.99] == [r.spark for r in rounded]
