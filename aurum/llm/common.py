"""Helpers shared by the corpus operators: staging in the shared folder, unused column names, bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.session import shared_path

#: Rows of two longs that one executor can hold several times over (about 32 MB as a hash table).
BROADCAST_ROWS = 1_000_000
#: ASCII white space, the separators of words.
WORD = "[^\\x20\\x09-\\x0D]+"


def staged(df: DataFrame, name: str, codec: str = "zstd", partition_by: str | None = None) -> DataFrame:
    """``df`` written to a fresh table under the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, "llm", name)
    writer = df.write.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    schema = df.schema
    return df.sparkSession.read.schema(schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front, whichever no column of ``df`` has (case does not count)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the staged table ``df`` is small enough by its (footer) row count; else ``df`` as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def column(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` cast to ``kind``; nulls if ``df`` has none (tables written without any row may lack it)."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def n_words(text: Column) -> Column:
    """The number of ``[^\\x20\\x09-\\x0D]+`` words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
