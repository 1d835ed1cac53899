"""Documents with sparse attributes, stored as ``map<string, json-text>`` bodies.

Each top-level field maps to its JSON text, so nested objects stay whole, an
explicit ``null`` is kept (as the text ``null``) and differs from an absent
field.  An upsert is a full outer join on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_documents(df: DataFrame, key: str, fields=None) -> DataFrame:
    """Rows -> (key, body) with every non-null field as JSON text."""
    fields = [c for c in (fields or df.columns) if c != key]
    entries = [F.when(F.col(c).isNotNull(),
                      F.struct(F.lit(c).alias("k"), F.to_json(F.struct(F.col(c).alias("v"))).alias("v")))
               for c in fields]
    arr = F.filter(F.array(*entries), lambda e: e.isNotNull())
    # {"v": …} wrapper -> the bare value text
    arr = F.transform(arr, lambda e: F.struct(e["k"].alias("k"),
                                               F.regexp_extract(e["v"], r'^\{"v":(.*)\}$', 1).alias("v")))
    return df.select(F.col(key), F.map_from_entries(arr).alias("body"))


def from_json_object(df: DataFrame, key: str, json_col: str) -> DataFrame:
    """A JSON object column -> (key, body) keeping each top-level field's JSON text.

    The values go through VARIANT, which keeps their JSON types: ``"007"`` stays a quoted
    text and an explicit ``null`` stays the text ``null``, as ``to_documents`` writes them.
    """
    fields = F.from_json(F.col(json_col), "map<string,variant>")
    return df.select(F.col(key), F.transform_values(fields, lambda _, v: F.to_json(v)).alias("body"))


def upsert_documents(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Top-level fields of ``new`` replace the stored ones; other stored fields stay."""
    b, n = base.alias("b"), new.alias("n")
    j = b.join(n, F.col(f"b.{key}") == F.col(f"n.{key}"), "full_outer")
    old, upd = F.col("b.body"), F.col("n.body")
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(upd), k))
    body = (F.when(upd.isNull(), old)
            .when(old.isNull(), upd)
            .otherwise(F.map_concat(kept, upd)))
    return j.select(F.coalesce(F.col(f"b.{key}"), F.col(f"n.{key}")).alias(key), body.alias("body"))


def field(body: str, name: str, dtype: str = "string") -> Column:
    """A field of the body as ``dtype`` (null when absent or JSON null; text without its quotes)."""
    return F.try_variant_get(F.try_parse_json(F.col(body)[name]), "$", dtype)


def as_variant(body: str, name: str) -> Column:
    """A field of the body as a VARIANT (for path access with ``variant_get``)."""
    return F.try_parse_json(F.col(body)[name])
