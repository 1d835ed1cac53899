"""Data-contract rules as total boolean expressions.

A rule is ``True`` when the row conforms.  Rules are made total with
``coalesce(rule, false)``: a null measure is a violation, never an unknown
that makes the row vanish from both the clean and the quarantine output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aurum import config as C
from aurum.config import DomainConfig, LITERACY


def total(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def completeness(cfg: DomainConfig = LITERACY, cols=None) -> Column:
    names = cols or (cfg.id_col, cfg.group_col, cfg.year_col)
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).isNotNull()
    return out


def accuracy(cfg: DomainConfig = LITERACY) -> Column:
    rate, score = F.col(cfg.rate_col), F.col(cfg.score_col)
    rule = (rate.between(cfg.rate_min, cfg.rate_max)
            & score.between(cfg.score_min, cfg.score_max))
    return total(rule)


def validity(cfg: DomainConfig = LITERACY, id_col: str | None = None) -> Column:
    """Exactly ``id_length`` characters, all of them digits."""
    c = F.col(id_col or cfg.id_col).cast("string")
    rule = (F.length(c) == cfg.id_length) & c.rlike(r"^[0-9]+$")
    return total(rule)


def rejection_reason(cfg: DomainConfig = LITERACY, validity_rule: Column | None = None) -> Column:
    """First failing rule, or null for a conforming row."""
    v = validity(cfg) if validity_rule is None else validity_rule
    return (F.when(~completeness(cfg), F.lit(C.REASON_COMPLETENESS))
            .when(~accuracy(cfg), F.lit(C.REASON_ACCURACY))
            .when(~v, F.lit(C.REASON_VALIDITY)))


def id_prefix_code(id_col: str, start: int = 1, length: int = 2) -> Column:
    """Numeric code embedded in an id (e.g. the state code in the first two digits)."""
    return F.substring(F.col(id_col), start, length).try_cast("int")
