"""Exact de-duplication by two-pass Bloom filtering, with DataFrame functions only.

Pass one hashes every text into one of ``16 * rows`` (rounded up to a power of two) counting cells.  Only cells that
two or more rows hit are kept, and those are inserted into a blocked Bloom filter: rows ``(word, mask)`` of 64-bit
words in which each cell sets three bits.  Pass two reads the documents again and tests every row against the
filter.  A row that fails the test has a text that occurs once and passes straight through with no shuffle; the rest
(true copies and a few per cent of false positives) is grouped by SHA-256.  A false positive only costs the shuffle
of a slim row, so the result is exact for any filter size.

Scale: pass one shuffles a partially aggregated ``(cell, count)`` per distinct text of a task, never the text.  The
filter has about ten bits for each repeated cell and is broadcast while its counted rows fit a stated bound; beyond
it the same test runs as a shuffle join, in ``verdicts`` of slim rows (ids and hashes), in ``deduplicate`` of whole rows,
which it has to return.  A text that a third of all rows share is aggregated before
its shuffle, and its group's figures are staged, so that the join which returns them to its rows is one that adaptive
execution can split.

Defined results: a null text counts as empty.  Rows with a null ``doc_id`` take part; they are kept only if the
whole group has none.  Rows that repeat both id and text cannot be told apart by their verdict; ``deduplicate``
keeps one of them.  An empty table gives an empty result.  Other columns of the input are ignored by ``verdicts``
and returned unchanged by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import BROADCAST_ROWS, bounded, staged, unused

CELLS_PER_ROW = 16
KEYS_PER_WORD = 6
MASK_BITS = 3


def _cell(text_hash: Column, cells: int) -> Column:
    return text_hash.bitwiseAND(F.lit(cells - 1))


def _word(cell: Column, words: int) -> Column:
    return F.xxhash64(cell, F.lit(1)).bitwiseAND(F.lit(words - 1))


def _mask(cell: Column) -> Column:
    h = F.xxhash64(cell, F.lit(2))
    mask = F.lit(0).cast("long")
    for i in range(MASK_BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def _power_of_two(n: int) -> int:
    return 1 << max(6, (max(1, n) - 1).bit_length())


class BloomFilter:
    """The possibly repeated texts of a table: a staged ``(word, mask)`` table and the sizes it was built with."""

    def __init__(self, table: DataFrame, cells: int, words: int, broadcast_rows: int) -> None:
        self.table, self.cells, self.words, self.broadcast_rows = table, cells, words, broadcast_rows

    def test(self, rows: DataFrame, text_hash: Column, flag: str) -> DataFrame:
        """``rows`` with the boolean column ``flag``: false only if the text of this ``xxhash64`` occurs once in the fitted table."""
        cell = _cell(text_hash, self.cells)
        word, mask = unused(rows, "bloom_word"), unused(rows, "bloom_mask")
        table = bounded(self.table.toDF(word, mask), self.broadcast_rows)
        need = unused(rows, "bloom_need")
        probed = rows.withColumns({word: _word(cell, self.words), need: _mask(cell)})
        hit = F.coalesce(F.col(mask).bitwiseAND(F.col(need)) == F.col(need), F.lit(False))
        return probed.join(table, word, "left").withColumn(flag, hit).drop(word, mask, need)


def fit(docs: DataFrame, text: Column, broadcast_rows: int = BROADCAST_ROWS) -> BloomFilter:
    """First pass: count cells over every row and build the filter of the cells that more than one row hits."""
    cells = _power_of_two(CELLS_PER_ROW * docs.count())
    repeated = staged(
        docs.select(_cell(F.xxhash64(text), cells).alias("cell")).groupBy("cell").count().where("count > 1").select("cell"),
        "bloom_cells")
    words = _power_of_two(repeated.count() // KEYS_PER_WORD)
    table = staged(
        repeated.select(_word(F.col("cell"), words).alias("word"), _mask(F.col("cell")).alias("mask"))
        .groupBy("word").agg(F.expr("bit_or(mask)").alias("mask")), "bloom_filter")
    return BloomFilter(table, cells, words, broadcast_rows)


def _text(docs: DataFrame) -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def verdicts(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    body = _text(docs)
    bloom = fit(docs, body, broadcast_rows)
    # hashed before the test: where the filter is too large to broadcast, only these slim rows are shuffled
    hashed = docs.select("doc_id", F.xxhash64(body).alias("hash"), F.sha2(body, 256).alias("text_sha256"))
    slim = staged(bloom.test(hashed, F.col("hash"), "maybe").select("doc_id", "maybe", "text_sha256"), "dedup_hashes")
    once = slim.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    maybe = slim.where("maybe")
    groups = staged(maybe.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "dedup_groups")
    again = maybe.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return once.unionByName(again)


def deduplicate(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with one row (the largest ``doc_id``) of each text; its columns and nothing else."""
    body = _text(docs)
    bloom = fit(docs, body, broadcast_rows)
    flag, digest, keep = (unused(docs, x) for x in ("maybe", "digest", "keep"))
    tested = bloom.test(docs, F.xxhash64(body), flag)
    once = tested.where(~F.col(flag)).select(*docs.columns)
    maybe = tested.where(flag).drop(flag).withColumn(digest, F.sha2(body, 256))
    groups = staged(maybe.groupBy(digest).agg(F.max("doc_id").alias(keep)), "dedup_groups")
    best = maybe.join(groups, digest).where(F.col("doc_id").eqNullSafe(F.col(keep)))
    return once.unionByName(best.dropDuplicates([digest]).select(*docs.columns))
