"""Connected components of a table of links, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import staged


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    return row[0], row[1] or 0


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of all nodes of ``links`` (``a``, ``b``: longs); staged.

    Each step is an aggregation and a join that is staged, and the number of steps grows with the logarithm of the
    size of the largest component; no task sees a whole component.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "links")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), "links")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "links")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(small.where("a <> b").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return staged(edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                  .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "links")
