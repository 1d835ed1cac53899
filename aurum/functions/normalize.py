"""Key normalisation: zero-padded ids and upper-case codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.config import DomainConfig, LITERACY


def pad_id(c, length: int = 7) -> Column:
    """Left-pad with zeros to ``length``; longer values stay whole, so distinct ids stay distinct."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.lpad(text, F.greatest(F.lit(length), F.length(text)), F.lit("0"))


def upper_code(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.upper(col)


def normalize(df: DataFrame, cfg: DomainConfig = LITERACY, id_cols=None) -> DataFrame:
    """Pad every id-bearing column and upper-case the group code (when present)."""
    cols = {}
    for c in (id_cols or (cfg.id_col,)):
        if c in df.columns:
            cols[c] = pad_id(c, cfg.id_length)
    if cfg.group_col in df.columns:
        cols[cfg.group_col] = upper_code(cfg.group_col)
    return df.withColumns(cols) if cols else df
