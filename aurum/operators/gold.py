"""Gold star schema: dimensions and facts built from the silver fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.config import DomainConfig, LITERACY
from aurum.functions import indicators as I
from aurum.functions.normalize import pad_id
from aurum.functions.rounding import round_half_up
from aurum.operators.dedupe import latest_per_key

CONTEXT_SCHEMA = T.StructType([
    T.StructField("id_municipio", T.StringType(), True),
    T.StructField("taxa_infraestrutura_basica", T.DoubleType(), True),
    T.StructField("localizacao_predominante", T.StringType(), True),
])


def present(df: DataFrame, wanted) -> list[str]:
    """Presence-dependent projection: the wanted columns that exist, in order."""
    return [c for c in wanted if c in df.columns]


def dim_time(silver: DataFrame, cfg: DomainConfig = LITERACY) -> DataFrame:
    y = cfg.year_col
    return (silver.select(y).distinct()
            .withColumn("decada", I.decade(y))
            .withColumn("periodo_meta", I.period_label(y, cfg)))


def dim_entity(silver: DataFrame, cfg: DomainConfig = LITERACY) -> DataFrame:
    """One row per entity; attributes of its latest year (deterministic survivor)."""
    cols = [cfg.id_col, cfg.group_col] + present(silver, [cfg.entity_name_col, cfg.region_col])
    src = silver.select(*cols, cfg.year_col)
    return latest_per_key(src, [cfg.id_col], [cfg.year_col]).drop(cfg.year_col)


def dim_group(silver: DataFrame, cfg: DomainConfig = LITERACY) -> DataFrame:
    cols = [cfg.group_col] + present(silver, [cfg.group_name_col, cfg.region_col, "populacao"])
    src = silver.select(*cols, cfg.year_col)
    return latest_per_key(src, [cfg.group_col], [cfg.year_col]).drop(cfg.year_col)


def empty_context(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CONTEXT_SCHEMA)


def _urban_flag(loc):
    """1 for urban, 0 otherwise; accepts the code form (1/2) or the text form."""
    s = F.lower(F.trim(loc.cast("string")))
    return F.when(s.isin("1", "urbana", "urbano", "urban"), 1.0).otherwise(0.0)


def dim_context(census: DataFrame, cfg: DomainConfig = LITERACY,
                location_col: str | None = None, infra_col: str | None = None) -> DataFrame:
    """Share of urban rows and of rows with basic infrastructure, per entity."""
    loc = location_col or next((c for c in ("tp_localizacao", "localizacao") if c in census.columns), None)
    infra = infra_col or ("in_agua_potavel" if "in_agua_potavel" in census.columns else None)
    if loc is None:
        raise ValueError("census input has no location column")
    infra_share = (F.avg(F.when(F.col(infra).cast("string") == "1", 1.0).otherwise(0.0)) * 100
                   if infra else F.lit(None).cast("double"))
    agg = (census.withColumn(cfg.id_col, pad_id(cfg.id_col, cfg.id_length))
           .groupBy(cfg.id_col)
           .agg(round_half_up(infra_share, 2).alias("taxa_infraestrutura_basica"),
                (F.avg(_urban_flag(F.col(loc))) * 100).alias("_perc_urbano")))
    return agg.select(cfg.id_col, "taxa_infraestrutura_basica",
                      I.location_label("_perc_urbano", cfg).alias("localizacao_predominante"))


def fact_indicator(silver: DataFrame, cfg: DomainConfig = LITERACY) -> DataFrame:
    score = cfg.score_col
    df = (silver
          .withColumn("nota_corte_saeb", F.lit(cfg.cutoff))
          .withColumn("gap_proficiencia", I.gap_to_cutoff(score, cfg))
          .withColumn("atingiu_corte_alfabetizado", I.reached_cutoff(score, cfg)))
    df = df.withColumn("status_intervencao", I.intervention_status("gap_proficiencia", cfg))
    base = [cfg.id_col, cfg.group_col, cfg.year_col, score, "nota_corte_saeb", "gap_proficiencia",
            "atingiu_corte_alfabetizado", "status_intervencao"]
    return df.select(*base, *present(df, [cfg.rate_col, "total_alunos_avaliados"]))


def fact_target(silver: DataFrame, cfg: DomainConfig = LITERACY) -> DataFrame | None:
    """Target versus result; ``None`` when the silver fact carries no target."""
    if cfg.target_col not in silver.columns:
        return None
    df = silver.select(cfg.id_col, cfg.group_col, cfg.year_col,
                       F.col(cfg.target_col).alias("meta_oficial"),
                       F.col(cfg.rate_col).alias("indicador_real"))
    df = df.withColumn("gap_percentual", I.percent_gap("indicador_real", "meta_oficial"))
    return df.withColumn("status_cumprimento",
                         I.fulfilment_status("indicador_real", "meta_oficial", "gap_percentual", cfg))


def level_target(metas: DataFrame, keys, cfg: DomainConfig = LITERACY) -> DataFrame:
    """Target versus result at an aggregate level (state or nation): one row per ``keys``.

    Adds the percent gap and fulfilment status of ``fact_target`` and the
    cutoff gap and flag of ``fact_indicator`` for the level's mean score.
    """
    df = metas.select(*keys, F.col(cfg.target_col).alias("meta_oficial"),
                      F.col(cfg.rate_col).alias("indicador_real"), F.col(cfg.score_col))
    df = df.withColumn("gap_percentual", I.percent_gap("indicador_real", "meta_oficial"))
    return (df.withColumn("status_cumprimento",
                          I.fulfilment_status("indicador_real", "meta_oficial", "gap_percentual", cfg))
              .withColumn("gap_proficiencia", I.gap_to_cutoff(cfg.score_col, cfg))
              .withColumn("atingiu_corte_alfabetizado", I.reached_cutoff(cfg.score_col, cfg)))


def build_gold(silver: DataFrame, census: DataFrame | None = None,
               cfg: DomainConfig = LITERACY, metas_uf: DataFrame | None = None,
               metas_brasil: DataFrame | None = None) -> dict[str, DataFrame]:
    spark = silver.sparkSession
    out = {
        "dim_tempo": dim_time(silver, cfg),
        "dim_municipio": dim_entity(silver, cfg),
        "dim_uf": dim_group(silver, cfg),
        "dim_contexto_escolar": dim_context(census, cfg) if census is not None else empty_context(spark),
        "fato_indicador_alfabetizacao": fact_indicator(silver, cfg),
    }
    target = fact_target(silver, cfg)
    if target is not None:
        out["fato_metas_vs_resultado"] = target
    if metas_uf is not None:
        uf = metas_uf.withColumn(cfg.group_col, F.upper(cfg.group_col))
        out["fato_metas_uf"] = level_target(uf, [cfg.group_col, cfg.year_col], cfg)
    if metas_brasil is not None:
        out["fato_metas_brasil"] = level_target(metas_brasil, [cfg.year_col], cfg)
    return out
