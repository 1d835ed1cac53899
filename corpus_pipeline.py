"""Corpus pipeline: toxic documents go, then copies, then near copies; the rest is mixed by source and packed.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept.  All but the last return the
columns of ``documents``; the mix repeats the documents that it takes more than once.  The last returns the pieces of
the packed sequences.  ``run`` writes what a stage returns to a Parquet table in the shared folder and hands that to
the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aurum.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from aurum.llm.common import staged
from aurum.llm.queries import PACK_END_ID, TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, TOKENIZER, PACK_END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity and packing are no SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that remain of ``documents`` after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
