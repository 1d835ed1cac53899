"""Derived indicators of the gold layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aurum import config as C
from aurum.config import DomainConfig, LITERACY
from aurum.functions.rounding import round_half_up


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def gap_to_cutoff(score, cfg: DomainConfig = LITERACY) -> Column:
    """round(cutoff - score, 2): positive means below the cutoff."""
    return round_half_up(F.lit(cfg.cutoff) - _c(score), 2)


def reached_cutoff(score, cfg: DomainConfig = LITERACY) -> Column:
    return _c(score) >= F.lit(cfg.cutoff)


def intervention_status(gap, cfg: DomainConfig = LITERACY) -> Column:
    """gap > 50 CRITICO, gap > 0 ATENCAO, else ADEQUADO (on the rounded gap)."""
    g = _c(gap)
    out = (F.when(g > cfg.intervention_gap, F.lit(C.STATUS_CRITICAL))
           .when(g > 0.0, F.lit(C.STATUS_ATTENTION)))
    if cfg.null_safe_status:
        return out.when(g.isNotNull(), F.lit(C.STATUS_ADEQUATE))
    return out.otherwise(F.lit(C.STATUS_ADEQUATE))


def percent_gap(real, target) -> Column:
    """round((real - target) / target * 100, 2); null for a zero or null target."""
    ratio = F.try_divide(_c(real) - _c(target), _c(target))
    return round_half_up(ratio * F.lit(100.0), 2)


def fulfilment_status(real, target, pct_gap, cfg: DomainConfig = LITERACY) -> Column:
    r, t, g = _c(real), _c(target), _c(pct_gap)
    out = (F.when(r >= t, F.lit(C.STATUS_MET))
           .when(g >= cfg.partial_gap_pct, F.lit(C.STATUS_PARTIAL)))
    if cfg.null_safe_status:
        return out.when(r.isNotNull() & t.isNotNull(), F.lit(C.STATUS_NOT_MET))
    return out.otherwise(F.lit(C.STATUS_NOT_MET))


def decade(year) -> Column:
    return (F.floor(_c(year) / 10) * 10).cast("string")


def period_label(year, cfg: DomainConfig = LITERACY) -> Column:
    y = _c(year)
    (a1, b1), (a2, b2) = cfg.period_first, cfg.period_second
    out = F.when(y.between(a1, b1), F.lit(C.PERIOD_FIRST))
    if cfg.null_safe_status:
        return out.when(y.between(a2, b2), F.lit(C.PERIOD_SECOND))
    return out.otherwise(F.lit(C.PERIOD_SECOND))


def location_label(urban_pct, cfg: DomainConfig = LITERACY) -> Column:
    u = _c(urban_pct)
    return (F.when(u >= cfg.urban_share, F.lit(C.LOCATION_URBAN))
            .when(u <= cfg.rural_share, F.lit(C.LOCATION_RURAL))
            .when(u.isNotNull(), F.lit(C.LOCATION_MIXED)))


def policy_band(pct_met, cfg: DomainConfig = LITERACY) -> Column:
    p = _c(pct_met)
    return (F.when(p >= cfg.policy_low, F.lit(C.POLICY_LOW))
            .when(p >= cfg.policy_medium, F.lit(C.POLICY_MEDIUM))
            .otherwise(F.lit(C.POLICY_HIGH)))
