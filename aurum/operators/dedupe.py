"""Latest row per key.

``row_number() == 1`` over a total order.  Spark plans it as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so even a
key that holds a third of the rows reaches the exchange as at most one row
per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, keys, order_cols, descending: bool = True) -> list[Column]:
    """The given order columns first, then every other column: a total order."""
    rest = [c for c in df.columns if c not in set(keys) | set(order_cols)]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def sortable(name: str) -> Column:
        # maps and variants have no order of their own; their JSON text has
        kind = kinds.get(name, "")
        return F.to_json(F.col(name)) if "map<" in kind or "variant" in kind else F.col(name)

    cols = [sortable(c) for c in list(order_cols) + rest]
    if descending:
        return [c.desc_nulls_last() for c in cols]
    return [c.asc_nulls_first() for c in cols]


def latest_per_key(df: DataFrame, keys, order_cols, n: int = 1,
                   descending: bool = True, rank_col: str | None = None) -> DataFrame:
    """Keep the ``n`` latest rows per key (ties broken by all other columns).

    With ``rank_col`` the position (1 = latest) is kept in that column.
    """
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order_cols, descending))
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def latest_delivery(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep the rows of each key's latest delivery; a delivery may hold several rows of a key.

    Like the latest row, a rank of 1: older deliveries of a hot key do not reach the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") == 1).drop("_rk")


def order_column(df: DataFrame, preferred=("_ingestion_timestamp",), fallback: str = "ano") -> str:
    """The de-duplication order column: the first preferred one present, else ``fallback``."""
    for c in preferred:
        if c in df.columns:
            return c
    return fallback
