"""Small tables from driver-side literals, planned as JVM-only relations.

``createDataFrame`` on a Python list goes through Python workers; a handful of
configuration or metric rows does not need them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_frame(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """A DataFrame of ``rows`` (tuples or dicts) with exactly ``schema``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = schema.fieldNames()
    structs = []
    for r in rows:
        vals = [r.get(n) for n in names] if isinstance(r, dict) else list(r)
        structs.append(F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                                  for v, f in zip(vals, schema.fields)]))
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields])
