"""Source extracts with ordered fall-back readers.

A source is a list of readers tried in order (warehouse / JDBC query, then a
file fall-back).  The first that opens and is not empty wins; an empty or
missing optional source is skipped, a missing required one is an error.
"""

from __future__ import annotations

import logging

from dataclasses import dataclass, field
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Reader = Callable[[SparkSession], DataFrame]

log = logging.getLogger(__name__)


@dataclass
class SourceSpec:
    name: str
    readers: list = field(default_factory=list)
    required: bool = False


def read_first_available(spark: SparkSession, readers) -> tuple[DataFrame | None, int]:
    """(frame, index of the reader that delivered) or (None, -1)."""
    for i, read in enumerate(readers):
        try:
            df = read(spark)
        except Exception as exc:  # a reader that cannot open falls through to the next one
            log.info("reader %d could not open its source: %s", i, exc)
            continue
        if df is not None and not df.isEmpty():
            return df, i
    return None, -1


def query_reader(fmt: str, **options) -> Reader:
    """A warehouse/JDBC-style reader: ``format(fmt).options(...).load()``."""
    def read(spark: SparkSession) -> DataFrame:
        return spark.read.format(fmt).options(**options).load()
    return read


def parquet_reader(path: str) -> Reader:
    return lambda spark: spark.read.parquet(path)


def csv_reader(path: str, columns) -> Reader:
    return lambda spark: read_csv_strings(spark, path, columns)


def read_csv_strings(spark: SparkSession, path: str, columns) -> DataFrame:
    """Header CSV with every declared column typed as string (no inference)."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(path)


def read_bronze(spark: SparkSession, path: str, merge_schema: bool = True,
                schema: T.StructType | None = None) -> DataFrame | None:
    """All batches under a bronze prefix as one frame; ``None`` when the path is absent.

    With a declared ``schema`` no footer is read to infer one (batches that
    lack a declared column read it as null); otherwise the batches' schemas
    are merged.
    """
    try:
        if schema is not None:
            return spark.read.schema(schema).parquet(path)
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as exc:
        if no_table(exc):
            return None
        raise


def no_table(exc: AnalysisException) -> bool:
    """Whether a read failed only because nothing was written at its path."""
    return exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_declared(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """The table under ``path`` with a declared schema; no row if no file (or no path) is there."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as exc:
        if not no_table(exc):
            raise
        return spark.createDataFrame([], schema)


def extract(df: DataFrame, columns: dict | list | None = None, where: Column | None = None,
            order_by=None, limit: int | None = None) -> DataFrame:
    """The extract query: filter, project (with renames), ordered limit.

    ``columns`` is a list of names or a mapping ``output -> input column/Column``.
    A limit is applied after ordering by ``order_by``, so the sample repeats.
    """
    if where is not None:
        df = df.where(where)
    if columns is not None:
        if isinstance(columns, dict):
            df = df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()])
        else:
            df = df.select(*columns)
    if limit is not None:
        if order_by:
            df = df.orderBy(*order_by)
        df = df.limit(limit)
    return df


def read_inputs(spark: SparkSession, specs) -> dict[str, DataFrame | None]:
    """Open every source; a required one that yields nothing raises."""
    out = {}
    for spec in specs:
        df, _ = read_first_available(spark, spec.readers)
        if df is None and spec.required:
            raise RuntimeError(f"required source {spec.name!r} is missing or empty")
        out[spec.name] = df
    return out
