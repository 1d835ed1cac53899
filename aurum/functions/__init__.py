"""Column expressions (JVM-side built-ins only; no Python UDFs)."""

from aurum.functions.rounding import round_half_up, pct
from aurum.functions.rules import (
    completeness, accuracy, validity, total, rejection_reason, id_prefix_code,
)
from aurum.functions.normalize import pad_id, upper_code, normalize
from aurum.functions.indicators import (
    gap_to_cutoff, reached_cutoff, intervention_status, percent_gap,
    fulfilment_status, decade, period_label, location_label, policy_band,
)

__all__ = [
    "round_half_up", "pct", "completeness", "accuracy", "validity", "total",
    "rejection_reason", "id_prefix_code", "pad_id", "upper_code", "normalize",
    "gap_to_cutoff", "reached_cutoff", "intervention_status", "percent_gap",
    "fulfilment_status", "decade", "period_label", "location_label", "policy_band",
]
