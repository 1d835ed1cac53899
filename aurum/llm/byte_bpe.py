"""Byte-level BPE by two tiers: whole pre-tokens through a minimal perfect hash, the others through a heap of merges.

A pattern splits a text into pre-tokens, each of which is encoded on its own.  Tier one: a minimal perfect hash gives
every token of the vocabulary a slot of its own, with no empty slot.  Its buckets of hashed tokens are placed from the
largest to the smallest, each by the first displacement that sends its tokens to free slots; buckets of one token are
given the slots left over.  A pre-token goes to one slot, and if the token there has the same bytes, its id is the
answer.  Tier two: the other pre-tokens start as a linked list of their bytes; a heap yields the pair of neighbours of
least rank, the leftmost of equal ones, which is joined, and the pairs with the new neighbours enter the heap.  So n
bytes take O(n log n) steps, however long the pre-token.  Merges of tier two repeat from text to text; each worker
remembers those of short pre-tokens, in two generations of bounded size.

Decoding joins the bytes of the ids, so it gives the bytes of the text back whatever the tokens are.

The hash is built once on the driver and shipped (a few bytes a token); a task reads the rank file from its path.
Texts are encoded where they are read, without a shuffle, in groups of about ``GROUP`` characters.

Defined results: a null text counts as empty and has no ids.  Strings of special tokens are ordinary text.  Texts of any
length are encoded whole.  Repeated rows give one result each, null ids are kept, an empty table gives none, and other columns
are ignored, whatever their names.  A vocabulary without all 256 single bytes, or an id beyond it, is an error.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 1_000_000
REMEMBERED = 800_000
LONGEST_REMEMBERED = 64
_PER_BUCKET = 4
_TRIES = 256


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (a base64 token and its rank on each line), by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without a gap")
    tokens = [ranks[i] for i in range(len(ranks))]
    if len({t for t in tokens if len(t) == 1}) != 256:
        raise ValueError("a byte-level vocabulary holds all 256 single bytes")
    return tokens


def _hashes(keys: list[bytes], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k, seed) for k in keys], np.uint64)


def _slots(hashes: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """The slot of each hash under a displacement (numpy wraps the products around)."""
    x = hashes + np.atleast_1d(displacement) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


@dataclass
class PerfectHash:
    """Minimal perfect hash of ``n`` keys: ``index[slot]`` is the key's place in the list it was built from.

    ``moves[bucket]`` is a displacement, or ``-1 - slot`` for a bucket of one key.
    """

    n: int
    seed: int
    moves: np.ndarray
    index: np.ndarray

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        if len(set(keys)) != len(keys):
            raise ValueError("keys must differ")
        seed = 0
        while len(set((hashes := _hashes(keys, seed)).tolist())) < len(keys):
            seed += 1
        n, buckets = len(keys), max(1, len(keys) // _PER_BUCKET)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=buckets)
        ends = np.cumsum(sizes)
        moves, index = np.zeros(buckets, np.int64), np.full(n, -1, np.int64)
        for b in np.argsort(-sizes, kind="stable").tolist():
            own = order[ends[b] - sizes[b]:ends[b]]
            if len(own) < 2:
                break
            start = 0
            while True:
                tries = np.arange(start, start + _TRIES, dtype=np.uint64)
                slots = np.sort(_slots(hashes[own][None, :], tries[:, None], n), axis=1)
                good = (index[slots] < 0).all(1) & (slots[:, 1:] != slots[:, :-1]).all(1)
                if good.any():
                    break
                start += _TRIES
            moves[b] = start + int(good.argmax())
            index[_slots(hashes[own], moves[b:b + 1].astype(np.uint64), n)] = own
        free = iter(np.flatnonzero(index < 0).tolist())
        for b in np.flatnonzero(sizes == 1).tolist():
            slot = next(free)
            moves[b], index[slot] = -1 - slot, order[ends[b] - 1]
        return cls(n, seed, moves, index)

    def places(self, keys: list[bytes]) -> np.ndarray:
        """For each key the place of the only key of the build that it can be equal to."""
        hashes = _hashes(keys, self.seed)
        moves = self.moves[(hashes % np.uint64(len(self.moves))).astype(np.int64)]
        return self.index[np.where(moves < 0, -1 - moves, _slots(hashes, np.maximum(moves, 0).astype(np.uint64), self.n))]


class Codec:
    """Encodes texts to packed little-endian unsigned 32-bit ids and back."""

    def __init__(self, tokens: list[bytes], pattern: str, vocabulary: PerfectHash) -> None:
        self.tokens, self.vocabulary = tokens, vocabulary
        self.pattern = regex.compile(pattern)
        self.of_byte = [0] * 256
        ranks = {t: i for i, t in enumerate(tokens)}
        for t, i in ranks.items():
            if len(t) == 1:
                self.of_byte[t[0]] = i
        #: left * n + right: the rank of the joined token
        self.joined = {ranks[t[:cut]] * len(tokens) + ranks[t[cut:]]: i for t, i in ranks.items()
                       for cut in range(1, len(t)) if t[:cut] in ranks and t[cut:] in ranks}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by the heap of merges."""
        n, size, joined = len(piece), len(self.tokens), self.joined
        ids = [self.of_byte[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [joined.get(a * size + b, -1) for a, b in zip(ids, ids[1:])] + [-1]
        heap = [rank * n + at for at, rank in enumerate(pair) if rank >= 0]
        heapify(heap)
        while heap:
            rank, at = divmod(heappop(heap), n)
            if pair[at] != rank:  # one of the two was joined to another neighbour meanwhile
                continue
            gone = after[at]
            right = after[at] = after[gone]
            ids[at], ids[gone], pair[gone], pair[at] = rank, -1, -1, -1
            if right < n:
                before[right] = at
                if (new := joined.get(rank * size + ids[right], -1)) >= 0:
                    pair[at] = new
                    heappush(heap, new * n + at)
            if (left := before[at]) >= 0:
                pair[left] = new = joined.get(ids[left] * size + rank, -1)
                if new >= 0:
                    heappush(heap, new * n + left)
        return [i for i in ids if i >= 0]

    def _resolved(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of distinct pre-tokens."""
        found, rest = {}, []
        for p in pieces:
            ids = self.young.get(p) or self.old.get(p)
            if ids is None:
                rest.append(p)
            else:
                found[p] = ids
        keys = [p.encode() for p in rest]
        for p, key, place in zip(rest, keys, self.vocabulary.places(keys).tolist(), strict=True):
            if self.tokens[place] == key:
                found[p] = struct.pack("<I", place)
                continue
            ids = self.merged(key)
            found[p] = packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(key) <= LONGEST_REMEMBERED:
                if len(self.young) >= REMEMBERED // 2:
                    self.young, self.old = {}, self.young
                self.young[p] = packed
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of a group of texts."""
        split = [self.pattern.findall(t) if len(t) <= GROUP else None for t in texts]
        found = self._resolved(set(chain.from_iterable(pieces for pieces in split if pieces)))
        return [self._long(text) if pieces is None else b"".join(map(found.__getitem__, pieces))
                for text, pieces in zip(texts, split, strict=True)]

    def _long(self, text: str) -> bytes:
        """A text whose pre-tokens are not all held at once."""
        out, pieces = [], (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(pieces, GROUP // 8)):
            out.append(b"".join(map(self._resolved(set(some)).__getitem__, some)))
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str, n: int, seed: int, moves: bytes, index: bytes) -> Codec:
    """One codec for each worker process, with the merges that its earlier tasks met."""
    return Codec(read_ranks(path), pattern, PerfectHash(n, seed, np.frombuffer(moves, np.int64), np.frombuffer(index, np.int64)))


@lru_cache(maxsize=2)
def _recipe(path: str, pattern: str) -> tuple:
    """What a task needs for its codec; the hash is built here, on the driver."""
    built = PerfectHash.build(read_ranks(path))
    return path, pattern, built.n, built.seed, built.moves.tobytes(), built.index.tobytes()


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers) of every whole text."""
    recipe = _recipe(path, pattern)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*recipe)
        for batch in batches:
            start, texts, held = 0, [], 0
            for at, text in enumerate(batch.column("text"), 1):
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= GROUP or at == len(batch):
                    ids = codec.encode(texts)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(start, at - start), pa.array([len(i) // 4 for i in ids], pa.int64()),
                         pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])
                    start, texts, held = at, [], 0

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(task, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` (``doc_id, n_tokens, ids``) with ``decoded``, the bytes of the ids; null ids count as none."""
    recipe = _recipe(path, pattern)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*recipe)
        for batch in batches:
            start, out, held = 0, [], 0
            for at, ids in enumerate(batch.column("ids"), 1):
                out.append(codec.decode(ids.as_py() or b""))
                held += len(out[-1])
                if held >= GROUP or at == len(batch):
                    columns = [c.slice(start, at - start) for c in batch.columns]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())],
                                                     names=["doc_id", "n_tokens", "ids", "decoded"])
                    start, out, held = at, [], 0

    return encoded.select("doc_id", "n_tokens", "ids") \
        .mapInArrow(task, "doc_id long, n_tokens long, ids binary, decoded binary")


def verdicts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the bytes that they decode to."""
    return decode(encode(docs, path, pattern), path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
