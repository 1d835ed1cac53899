"""Projections of gold facts for key-value caches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.config import DomainConfig, LITERACY
from aurum.functions.rounding import round_half_up


def format_fixed(c, scale: int = 2) -> Column:
    """A number as fixed-point text with ``scale`` decimals (``82.4`` -> ``"82.40"``)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(f"decimal(24,{scale})").cast("string")


def _json_num(c) -> Column:
    return F.coalesce(format_fixed(round_half_up(c, 2)), F.lit("null"))


def _json_str(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    esc = F.regexp_replace(F.regexp_replace(col, r"\\", r"\\\\"), '"', r'\\"')
    return F.coalesce(F.concat(F.lit('"'), esc, F.lit('"')), F.lit("null"))


def kv_projection(target: DataFrame, cfg: DomainConfig = LITERACY,
                  prefix: str = "kpi:municipio") -> DataFrame:
    """``kpi:municipio:{id}:ano:{year}`` -> ``{"taxa": …, "meta": …, "status": …}``.

    Numbers are written as fixed two-decimal text so the cached value does not
    depend on how an engine prints doubles.
    """
    key = F.concat(F.lit(prefix + ":"), F.col(cfg.id_col), F.lit(":ano:"), F.col(cfg.year_col).cast("string"))
    value = F.concat(F.lit('{"taxa": '), _json_num("indicador_real"),
                     F.lit(', "meta": '), _json_num("meta_oficial"),
                     F.lit(', "status": '), _json_str("status_cumprimento"), F.lit("}"))
    return target.select(key.alias("key"), value.alias("value"))
