"""Tables registered in Spark's catalog over files (instead of path globs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                      partitioned: bool = False, replace: bool = True) -> DataFrame:
    """``CREATE TABLE … USING fmt LOCATION path``; partitions discovered from the paths."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quote(name)} USING {fmt} LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {_quote(name)}")
    return spark.table(name)

