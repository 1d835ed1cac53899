"""Best-fit packing of token sequences with swap-based local search.

Documents are encoded where they are read and become slim piece rows; no text and no ids are shuffled.  A document of
more than ``capacity`` ids is cut into full pieces, the first one taking the rest.  Full pieces are sequences as they
are.  The others are dealt evenly, whatever their keys, to partitions of about ``ITEMS`` rows, and each partition is
packed on its own: best fit in decreasing order, then a local search among the underfull sequences that moves a piece
or exchanges one or two pieces for one whenever that raises the sum of squared fills, until the partition's lower bound
is reached or no step between any two of them helps.  A partition of that size loses at most a few sequences to the
bound of all rows, so the shard size does not limit the result; memory is bounded by ``ITEMS`` slim rows.

Defined results: a null or empty text is one piece that holds the end id alone.  Null ids and repeated rows are packed
like any other row, each on its own.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import staged
from aurum.llm.tokens import encoder

CAPACITY = 2048
ITEMS = 50_000
#: Sequences that one sweep of the local search looks at; after a sweep without a step all underfull ones are searched.
SWEEP = 400

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.ids(enc.encode(text.as_py()) + end).astype("<u4")
                first = len(ids) % capacity or capacity
                for k, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    start = 0 if k == 0 else stop - capacity
                    out.append((doc_id, k, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
            if out:
                a, b, c, d, e = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int32()), *(pa.array(x, pa.int64()) for x in (c, d, e))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECE)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of indices) of best fit in decreasing order; room left is looked up in one integer's bits."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int, sweep: int = SWEEP) -> list[list[int]]:
    """``bins`` after moves and one-for-one and two-for-one exchanges that raise the sum of squared fills.

    The sum is bounded and integral, so the search ends.  A step goes from the emptier sequence to a fuller one that
    stays within ``capacity``; a sequence without pieces is dropped.
    """
    size = lengths.tolist()
    bound = -(-sum(size) // capacity)
    fill = [sum(size[i] for i in b) for b in bins]
    while len(bins) > bound:
        under = sorted((b for b in range(len(bins)) if fill[b] < capacity), key=lambda b: fill[b])
        sources, targets = under[:sweep], under[::-1][:sweep]
        steps = 0
        for a in sources:
            for b in targets:
                if a != b and fill[a] <= fill[b] < capacity and bins[a]:
                    steps += _step(bins, fill, size, a, b, capacity)
        if not steps and not _search_all(bins, fill, size, under, capacity) and not _search_all(
                bins, fill, size, sorted(under, key=lambda b: (fill[b], -b)), capacity):  # equal fills the other way round
            break
        if empty := [b for b in range(len(bins)) if not bins[b]]:
            for b in reversed(empty):
                del bins[b], fill[b]
    return bins


def _search_all(bins: list[list[int]], fill: list[int], size: list[int], under: list[int], capacity: int) -> int:
    """One pass over all underfull bins, each with a partner that a step can fill; no step in both orders of equal fills
    means that none exists.

    From the fullest bin on: those before a bin are its possible partners, and of these the latest has most room, so
    for every length of a piece (0: none is taken back) the latest bin with it is enough.
    """
    ends = np.zeros(capacity + 1, np.int64)  # by length t: t and the room of the latest bin that has such a piece
    owner = np.full(capacity + 1, -1, np.int64)
    steps = 0
    for a in reversed(under):
        room, held = capacity - fill[a], [size[i] for i in bins[a]]
        reach = np.maximum.accumulate(ends)
        for give in (_singles, _pairs):
            sums = give(held)
            sums = sums[sums <= capacity]
            fits = sums[reach[sums - 1] >= sums]
            if len(fits):
                b = int(owner[np.argmax(ends[: int(fits[-1])])])
                if fill[a] <= fill[b] < capacity and bins[a]:
                    steps += _step(bins, fill, size, a, b, capacity)
                break
        else:  # unchanged, so a partner for those that follow
            lengths = np.array([0, *held], np.int64)
            ends[lengths] = lengths + room
            owner[lengths] = a
    return steps


def _singles(held: list[int]) -> np.ndarray:
    return np.unique(np.array(held, np.int64))


def _pairs(held: list[int]) -> np.ndarray:
    values = np.array(held, np.int64)
    first, second = np.triu_indices(len(values), 1)
    return np.unique(values[first] + values[second])


def _step(bins: list[list[int]], fill: list[int], size: list[int], a: int, b: int, capacity: int) -> bool:
    """One best step from bin ``a`` to the fuller bin ``b``: the exchange that fills ``b`` most."""
    room = capacity - fill[b]
    mine = {size[i]: i for i in bins[a]}
    theirs = {size[j]: j for j in bins[b]}
    lengths = sorted(mine)
    best, give, take = 0, (), ()
    for s in lengths:
        if best < s <= room:
            best, give, take = s, (mine[s],), ()
        for t, j in theirs.items():
            if best < s - t <= room:
                best, give, take = s - t, (mine[s],), (j,)
    if best < room and len(bins[a]) > 1:
        items = sorted(bins[a], key=lambda i: size[i])
        for t, j in theirs.items():
            lo, hi = 0, len(items) - 1  # two of mine for one of theirs, by two pointers
            while lo < hi:
                gain = size[items[lo]] + size[items[hi]] - t
                if gain > room:
                    hi -= 1
                    continue
                if gain > best:
                    best, give, take = gain, (items[lo], items[hi]), (j,)
                lo += 1
    if not best:
        return False
    for i in give:
        bins[a].remove(i)
        bins[b].append(i)
    for j in take:
        bins[b].remove(j)
        bins[a].append(j)
    fill[a] -= best
    fill[b] += best
    return True


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item."""
    full = np.flatnonzero(lengths >= capacity)
    rest = np.flatnonzero(lengths < capacity)
    bins = local_search(best_fit(lengths[rest], capacity), lengths[rest], capacity)
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bin_of[full] = np.arange(len(full))
    for b, items in enumerate(bins, len(full)):
        at = 0
        for i in rest[np.array(items, np.int64)].tolist():
            bin_of[i], offset[i] = b, at
            at += int(lengths[i])
    return bin_of, offset


def pack(piece_rows: DataFrame, capacity: int = CAPACITY, items: int = ITEMS) -> DataFrame:
    """Rows with a ``length`` (at most ``capacity``) and ``sequence_id, offset`` (longs) for each."""
    rows = staged(piece_rows, "pieces")
    schema = rows.schema.add("sequence_id", "long").add("offset", "long")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        table = list(batches)
        if not table:
            return
        table = pa.Table.from_batches(table)
        bin_of, offset = pack_lengths(table.column("length").to_numpy(), capacity)
        table = table.append_column("sequence_id", pa.array(base + bin_of)).append_column("offset", pa.array(offset))
        yield from table.to_batches()

    shards = max(1, -(-rows.count() // items))
    return rows.repartition(shards).mapInArrow(fill, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(pieces(docs, tokenizer, end_id, capacity), capacity)
