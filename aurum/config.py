"""Domain configuration: column roles and the constants of the indicator model.

The same operators run on the literacy schema (the default) and on any
other table whose columns are mapped onto these roles.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


# --- fixed values (must equal the published semantics) -----------------------
# Rejection reasons, in priority order completeness > accuracy > validity.
REASON_COMPLETENESS = "VIOLACAO_COMPLETUDE: Campos obrigatorios nulos"
REASON_ACCURACY = "VIOLACAO_ACURACIA: Metricas fora da escala permitida"
REASON_VALIDITY = "VIOLACAO_VALIDADE: Codigo IBGE com tamanho invalido"
# Reasons added by this library (no counterpart in the published code).
REASON_MALFORMED = "VIOLACAO_FORMATO: Mensagem JSON malformada"
REASON_TYPE = "VIOLACAO_TIPO: Valor nao convertivel ao tipo declarado"
REASON_RANGE = "VIOLACAO_FAIXA: Valor fora da faixa declarada"

# Status labels.
STATUS_CRITICAL = "CRITICO"
STATUS_ATTENTION = "ATENCAO"
STATUS_ADEQUATE = "ADEQUADO"
STATUS_MET = "ATINGIDA"
STATUS_PARTIAL = "PARCIAL"
STATUS_NOT_MET = "NAO_ATINGIDA"
LOCATION_URBAN = "Urbana"
LOCATION_RURAL = "Rural"
LOCATION_MIXED = "Mista"
POLICY_LOW = "Prioridade Baixa"
POLICY_MEDIUM = "Prioridade Media"
POLICY_HIGH = "Prioridade Alta (Intervencao Urgente)"
PERIOD_FIRST = "2023-2026"
PERIOD_SECOND = "2027-2030"
ALERT_LEVEL = "CRITICAL_ALERT"

# Stage names of the layered run.
STAGE_INGEST = "batch_ingestion"
STAGE_SILVER = "bronze_to_silver"
STAGE_GOLD = "silver_to_gold"

# Numbers of the model (defaults of DomainConfig below).
CUTOFF = 743.0                 # score cutoff
SCORE_RANGE = (0.0, 1000.0)    # inclusive
RATE_RANGE = (0.0, 100.0)      # inclusive
ID_LENGTH = 7
INTERVENTION_GAP = 50.0        # gap above this: critical
PARTIAL_GAP_PCT = -10.0        # percent gap at or above this: partial
URBAN_SHARE, RURAL_SHARE = 70.0, 30.0
POLICY_LOW_PCT, POLICY_MEDIUM_PCT = 80.0, 50.0
ALERT_RATE_PCT = 10.0          # quarantine rate strictly above this: alert
PERIOD_FIRST_YEARS, PERIOD_SECOND_YEARS = (2023, 2026), (2027, 2030)
# -----------------------------------------------------------------------------

# Public IBGE numeric state codes (not part of the published code): the first
# two digits of a municipality id, used by the consistency rule.
IBGE_STATE_CODES = (
    ("RO", 11), ("AC", 12), ("AM", 13), ("RR", 14), ("PA", 15), ("AP", 16), ("TO", 17),
    ("MA", 21), ("PI", 22), ("CE", 23), ("RN", 24), ("PB", 25), ("PE", 26), ("AL", 27),
    ("SE", 28), ("BA", 29), ("MG", 31), ("ES", 32), ("RJ", 33), ("SP", 35), ("PR", 41),
    ("SC", 42), ("RS", 43), ("MS", 50), ("MT", 51), ("GO", 52), ("DF", 53),
)
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class DomainConfig:
    """Column roles and thresholds.  Defaults are the literacy model."""

    # column roles
    id_col: str = "id_municipio"
    group_col: str = "sigla_uf"
    year_col: str = "ano"
    score_col: str = "media_proficiencia_saeb"
    rate_col: str = "indicador_alfabetizacao"
    target_col: str = "meta_alfabetizacao"
    entity_name_col: str = "nome_municipio"
    group_name_col: str = "nome_uf"
    region_col: str = "regiao"
    ingest_ts_col: str = "_ingestion_timestamp"

    # thresholds and ranges (inclusive ranges); defaults are the fixed values above
    cutoff: float = CUTOFF
    score_min: float = SCORE_RANGE[0]
    score_max: float = SCORE_RANGE[1]
    rate_min: float = RATE_RANGE[0]
    rate_max: float = RATE_RANGE[1]
    id_length: int = ID_LENGTH
    intervention_gap: float = INTERVENTION_GAP
    partial_gap_pct: float = PARTIAL_GAP_PCT
    urban_share: float = URBAN_SHARE
    rural_share: float = RURAL_SHARE
    policy_low: float = POLICY_LOW_PCT
    policy_medium: float = POLICY_MEDIUM_PCT
    alert_rate_pct: float = ALERT_RATE_PCT
    period_first: tuple = PERIOD_FIRST_YEARS
    period_second: tuple = PERIOD_SECOND_YEARS

    # behaviour switches
    strict_validity: bool = True   # evaluate the id rule on the raw id
    null_safe_status: bool = True  # null input -> null status (else legacy default branch)

    key_cols: tuple = field(default=("id_municipio", "ano"))

    def with_(self, **kw) -> "DomainConfig":
        return replace(self, **kw)


LITERACY = DomainConfig()
