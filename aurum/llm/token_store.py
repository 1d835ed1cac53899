"""Token-id files: every document compressed on its own with one shared zstandard dictionary.

``write`` encodes and compresses every document where it is read, then sorts the frames by ``doc_id`` over the cluster
(range partitioning; no text is shuffled, shards hold about ``SHARD_BYTES``) and writes blocks.  A block is a row of the table ``blocks``: the concatenated frames of consecutive documents
(``data``) and its offset index (``doc_ids``, ``ends``, ``counts``: the end byte and the number of ids of each
frame), the SHA-256 of the dictionary, and its place (``shard``, ``block``).  The index columns can be read without
the data column, and one short document costs one block row, one slice and one frame.  The table ``dictionary`` holds
the dictionary itself.

The dictionary is trained on the id arrays of at most ``DICTIONARY_DOCS`` documents (those of smallest
``xxhash64(doc_id)``; at most ``DICTIONARY_IDS`` ids of each), a bound that only affects compression.  With too few
samples to train on, documents are compressed without a dictionary, whose hash is then that of no bytes.

Defined results: a null or empty text is one frame that holds the end id alone.  Null ids sort last.  Repeated rows
each have a frame, in unspecified order among equal ids.  An empty table writes no block.  Other columns are ignored.
A single document is never split, so memory is bounded by the longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum.llm.common import bounded, staged
from aurum.llm.tokens import encoder

DICTIONARY_DOCS = 2_000
DICTIONARY_IDS = 8_192
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 1 << 20
SHARD_BYTES = 1 << 26
LEVEL = 3

_BLOCK = ("shard int, block int, n_docs int, n_ids long, doc_ids array<long>, ends array<long>, counts array<long>, "
          "dictionary_sha256 string, data binary")


def _dictionary(frames: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, frames).as_bytes()
    except zstandard.ZstdError:
        return b""


def train(docs: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """The shared dictionary, trained in one task on a bounded sample."""
    order = F.xxhash64(F.col("doc_id"))
    chosen = docs.select("doc_id").distinct().orderBy(order, "doc_id").limit(DICTIONARY_DOCS)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text")
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(DICTIONARY_DOCS)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        frames = [_packed(enc, t, end_id)[: DICTIONARY_IDS * enc.dtype.itemsize]
                  for b in batches for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([_dictionary(frames)], pa.binary())})

    rows = sample.select("text").coalesce(1).mapInArrow(fit, "dictionary binary").collect()
    return bytes(rows[0][0]) if rows else b""


def _packed(enc, text: str | None, end_id: int) -> bytes:
    return enc.encode(text) + np.array([end_id], enc.dtype).tobytes()


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write ``docs`` (``doc_id``, ``text``) as a token store under ``path``, in ascending order of ``doc_id``."""
    spark = docs.sparkSession
    dictionary = train(docs, tokenizer, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), tokenizer.rsplit("/", 1)[-1], end_id)],
                          "sha256 string, dictionary binary, tokenizer string, end_id int") \
        .write.parquet(f"{path}/dictionary")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, press = encoder(tokenizer), _compressor(dictionary)
        for batch in batches:
            start, counts, frames, size = 0, [], [], 0
            for at, text in enumerate(batch.column(1), 1):
                packed = _packed(enc, text.as_py(), end_id)
                counts.append(len(packed) // enc.dtype.itemsize)
                frames.append(press.compress(packed))
                size += len(frames[-1])
                if size >= BLOCK_BYTES or at == len(batch):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, at - start), pa.array(counts, pa.int64()), pa.array(frames, pa.binary())],
                        names=["doc_id", "n_ids", "frame"])
                    start, counts, frames, size = at, [], [], 0

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        ids, ends, counts, frames, size = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int32()),
                 pa.array([sum(counts)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([digest]), pa.array([b"".join(frames)], pa.binary())],
                names=["shard", "block", "n_docs", "n_ids", "doc_ids", "ends", "counts", "dictionary_sha256", "data"])

        for batch in batches:
            for doc_id, count, frame in zip(batch.column("doc_id").to_pylist(), batch.column("n_ids").to_pylist(),
                                            batch.column("frame"), strict=True):
                frame = frame.as_py()
                if frames and size + len(frame) > BLOCK_BYTES:
                    yield row()
                    block += 1
                    ids, ends, counts, frames, size = [], [], [], [], 0
                size += len(frame)
                frames.append(frame)
                ids.append(doc_id)
                ends.append(size)
                counts.append(count)
        if frames:
            yield row()

    # texts are encoded and compressed where they are read; ``place`` tells rows of one id apart, so they can be split
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(compress, "doc_id long, n_ids long, frame binary").withColumn("place", F.monotonically_increasing_id())
    packed = staged(packed, "token_frames", codec="uncompressed")
    held = packed.agg(F.sum(F.length("frame"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // SHARD_BYTES))
    order = F.col("doc_id").asc_nulls_last(), F.col("place").asc()
    ordered = packed.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(blocks, _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, str]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["sha256"]:
        raise ValueError(f"{path}: the dictionary does not have its stated hash")
    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks"), dictionary, row["sha256"]


def _starts(blocks: DataFrame) -> DataFrame:
    """``shard, block, first``: the number of ids before each block; only one row a shard meets in one task."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_first"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("in_shard")) \
        .join(shards, "shard").select("shard", "block", (F.col("shard_first") + F.col("in_shard")).alias("first"))


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every document from the files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids array<int>``."""
    blocks, dictionary, digest = _opened(spark, path)
    starts = bounded(staged(_starts(blocks), "token_starts"))  # one slim row a block
    wide = blocks.join(starts, ["shard", "block"]) \
        .select("first", "doc_ids", "ends", "counts", "dictionary_sha256", "data")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        plain = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != digest:
                    raise ValueError("a block was written with another dictionary")
                out, first, begin = [], row["first"], 0
                for doc_id, end, count in zip(row["doc_ids"], row["ends"], row["counts"], strict=True):
                    packed = plain.decompress(row["data"][begin:end])
                    ids = np.frombuffer(packed, f"<u{len(packed) // count}").astype("<u4")
                    out.append((doc_id, first, count, zlib.crc32(ids.tobytes()), ids if with_ids else None))
                    first, begin = first + count, end
                columns = list(zip(*out, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in columns[4]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return wide.mapInArrow(decode, schema)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """Ids of a few documents by the offset index: only the blocks that hold them are read and one frame of each."""
    blocks, dictionary, _ = _opened(spark, path)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    plain = zstandard.ZstdDecompressor(dict_data=shared)
    wanted = [int(x) for x in doc_ids]
    at = blocks.select(F.posexplode("doc_ids").alias("i", "doc_id"), "ends", "counts", "data") \
        .where(F.col("doc_id").isin(wanted)) \
        .withColumn("begin", F.when(F.col("i") > 0, F.col("ends")[F.col("i") - 1]).otherwise(F.lit(0))) \
        .select("doc_id", F.col("counts")[F.col("i")].alias("n"),
                F.expr("substring(data, int(begin) + 1, int(ends[i] - begin))").alias("frame"))
    out = {}
    for row in at.collect():
        packed = plain.decompress(bytes(row["frame"]))
        out[row["doc_id"]] = np.frombuffer(packed, f"<u{len(packed) // row['n']}").tolist()
    return out
