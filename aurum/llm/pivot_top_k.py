"""Exact top-k inner products by a pivot-distance index.

Vectors become integers, ``floor(scale * x)``.  With one more coordinate, ``sqrt(M^2 - |x|^2)`` for the largest norm M
of all vectors (0 for a query), the distance between a query and a vector falls as their inner product rises, so a
metric index answers inner-product queries: a vector's key is its nearest pivot and its distance to it, and the
distances of a pivot are cut into annuli.  For a query at distance d from a pivot, a vector at distance r cannot be
nearer than ``|d - r|``.  A query first scans the annuli with the least bound until they hold enough vectors; its
k-th score then excludes every annulus whose bound says that nothing in it scores as high, and the rest are scanned.
Scores are exact integers, the bounds are taken with a margin for rounding, and ties go to the smaller id, so the
result is that of a scan of all pairs.

The pivots and the cuts of the annuli are fitted on at most ``SAMPLE`` vectors (those of smallest ``xxhash64(vec_id)``);
every vector is indexed.  At most ``PIVOTS * ANNULI`` directory rows travel to the driver and the tasks.  Vectors of an
annulus are packed into blocks of about ``BLOCK`` and its queries into blocks of about ``QUERY_BLOCK``; pairs of blocks
meet in a shuffle join on the annulus and one matrix product scores each pair.  Only k rows a query leave a product.

Defined results: vectors that are null or hold a null or non-finite component, and rows without an id, take no part.
Of rows that repeat an id, the one whose vector is last in byte order counts.  Shorter vectors count as padded with
zeros.  Components beyond the range of a 32-bit integer after scaling, or norms beyond that of a 64-bit one, are an
error.  Fewer candidates than k give fewer rows; empty tables give none.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.common import staged

SCALE = 1024
K = 10
SAMPLE = 4096
PIVOTS = 64
ANNULI = 16
BLOCK = 1024
QUERY_BLOCK = 256
FIRST_SCAN = 512

_FOUND = "array<struct<query_id: bigint, vec_id: bigint, score: bigint>>"


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """The vectors that take part: ``vec_id, vec`` (packed little-endian 32-bit integers), ``norm2``, ``dim``; staged."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs, norms, dims = [], [], [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                items = v.values
                if vec_id is None or items is None or items.null_count:
                    continue
                x = np.floor(np.asarray(items.to_numpy(zero_copy_only=False), np.float64) * scale)
                if not np.isfinite(x).all():
                    continue
                if len(x) and np.abs(x).max() >= 2**31:
                    raise ValueError(f"vector {vec_id}: a component is out of range")
                norm = sum(int(c) * int(c) for c in x) if len(x) and np.abs(x).max() > 2**20 else int((x * x).sum())
                if norm >= 2**63:
                    raise ValueError(f"vector {vec_id}: the norm is out of range")
                ids.append(vec_id)
                vecs.append(x.astype("<i4").tobytes())
                norms.append(norm)
                dims.append(len(x))
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(ids, pa.int64()), "vec": pa.array(vecs, pa.binary()),
                "norm2": pa.array(norms, pa.int64()), "dim": pa.array(dims, pa.int32())})

    packed = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>")) \
        .mapInArrow(pack, "vec_id long, vec binary, norm2 long, dim int")
    one = packed.groupBy("vec_id").agg(F.max(F.struct("vec", "norm2", "dim")).alias("v"))
    return staged(one.select("vec_id", "v.*"), "top_k_vectors")


@dataclass
class Index:
    """Pivots (in the space with one more coordinate), cuts of the annuli, and the directory of what they hold."""

    pivots: np.ndarray
    cuts: np.ndarray
    dim: int
    largest: int
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    held: np.ndarray | None = None

    def lifted(self, vecs: list[bytes], query: bool) -> np.ndarray:
        x = np.zeros((len(vecs), self.dim + 1))
        for row, v in zip(x, vecs, strict=True):
            row[: len(v) // 4] = np.frombuffer(v, "<i4")
        if not query:
            x[:, -1] = np.sqrt(np.maximum(0.0, self.largest - (x * x).sum(1)))
        return x

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] - 2 * x @ self.pivots.T + (self.pivots**2).sum(1)))

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the annuli by ascending bound, and the highest score that each of these can hold."""
        d = np.repeat(self.distances(x), self.cuts.shape[1] + 1, axis=1)
        margin = 1e-6 * (1 + np.sqrt(self.largest) + d)
        low = np.maximum(0.0, np.maximum(d - self.far, self.near - d) - margin)
        low[:, self.held == 0] = np.inf
        order = np.argsort(low, axis=1, kind="stable")
        low = np.take_along_axis(low, order, 1)
        return order, ((x * x).sum(1)[:, None] + self.largest - low * low) / 2 + 1e-6 * (1 + self.largest)


def fit(vectors: DataFrame, sample: int = SAMPLE, pivots: int = PIVOTS, annuli: int = ANNULI) -> Index | None:
    """Pivots by k-means and cuts at quantiles of the sample's distances; None for an empty table."""
    top = vectors.agg(F.max("norm2").alias("norm2"), F.max("dim").alias("dim")).first()
    if top["dim"] is None:
        return None
    rows = vectors.select("vec_id", "vec").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    index = Index(np.zeros((1, top["dim"] + 1)), np.zeros((1, annuli - 1)), top["dim"], top["norm2"])
    x = index.lifted([bytes(r["vec"]) for r in rows], query=False)
    index.pivots = x[: max(1, min(pivots, len(x) // 8))].copy()
    for _ in range(10):
        nearest = index.distances(x).argmin(1)
        for p in range(len(index.pivots)):
            if (own := x[nearest == p]).size:
                index.pivots[p] = own.mean(0)
    d = index.distances(x)
    nearest, r = d.argmin(1), d.min(1)
    steps = np.linspace(0, 1, annuli + 1)[1:-1]
    index.cuts = np.stack([np.quantile(r[nearest == p], steps) if (nearest == p).any() else np.zeros(annuli - 1)
                           for p in range(len(index.pivots))])
    return index


def indexed(vectors: DataFrame, index: Index) -> DataFrame:
    """Every vector with its key: ``vec_id, item`` (id and padded vector, packed), ``annulus, distance``; staged."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column(1).to_pylist()
            d = index.distances(index.lifted(vecs, query=False))
            pivot = d.argmin(1) if len(vecs) else np.zeros(0, np.int64)
            r = d.min(1) if len(vecs) else np.zeros(0)
            ring = (index.cuts[pivot] < r[:, None]).sum(1)
            items = [i.to_bytes(8, "little", signed=True) + v.ljust(4 * index.dim, b"\0")
                     for i, v in zip(batch.column(0).to_pylist(), vecs, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0), "item": pa.array(items, pa.binary()),
                "annulus": pa.array(pivot * (index.cuts.shape[1] + 1) + ring, pa.int32()),
                "distance": pa.array(r, pa.float64())})

    return staged(vectors.select("vec_id", "vec").mapInArrow(
        key, "vec_id long, item binary, annulus int, distance double"), "top_k_index")


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``annulus, name``: packed items in blocks of about ``size``, dealt by a hash of the id."""
    n = rows.groupBy("annulus").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("blocks"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    return rows.join(n, "annulus").groupBy("annulus", part.alias("part")).agg(F.collect_list("item").alias(name)) \
        .select("annulus", name)


def _score(dim: int, k: int) -> Column:
    kind = np.dtype([("id", "<i8"), ("v", "<i4", (dim,))])

    @F.udf(returnType=_FOUND, useArrow=False)
    def score(queries: list[bytes], items: list[bytes]) -> list[tuple[int, int, int]]:
        q, x = np.frombuffer(b"".join(queries), kind), np.frombuffer(b"".join(items), kind)
        a, b = q["v"].reshape(len(q), dim), x["v"].reshape(len(x), dim)
        most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * dim
        if most >= 2**63:
            raise ValueError("scores are out of range")
        kind_of_sum = np.float64 if most < 2**53 else np.int64
        scores = (a.astype(kind_of_sum) @ b.astype(kind_of_sum).T).astype(np.int64)
        out = []
        for own, row in zip(q["id"].tolist(), scores, strict=True):
            at = np.flatnonzero(x["id"] != own)
            if len(at) > k:
                worst = np.partition(row[at], len(at) - k)[len(at) - k]
                at = at[row[at] >= worst]
                at = at[np.lexsort((x["id"][at], -row[at]))[:k]]
            out += [(own, int(x["id"][i]), int(row[i])) for i in at]
        return out

    return score("queries", "items")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of every row for which ``is_query`` holds."""
    spark = rows.sparkSession
    vectors = quantised(rows, scale)
    index = fit(vectors)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    keyed = indexed(vectors, index)
    directory = keyed.groupBy("annulus").agg(F.min("distance").alias("near"), F.max("distance").alias("far"),
                                             F.count(F.lit(1)).alias("held")).collect()  # PIVOTS * ANNULI rows at most
    cells = len(index.pivots) * (index.cuts.shape[1] + 1)
    index.near, index.far, index.held = np.zeros(cells), np.zeros(cells), np.zeros(cells, np.int64)
    for r in directory:
        index.near[r["annulus"]], index.far[r["annulus"]] = r["near"], r["far"]
        index.held[r["annulus"]] = r["held"]

    queries = staged(keyed.where(is_query).select("vec_id", "item"), "top_k_queries")
    data = staged(_blocks(keyed.select("annulus", "vec_id", "item"), BLOCK, "items"), "top_k_blocks")
    enough = max(k + 1, FIRST_SCAN)

    def route(first: bool):
        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items = batch.column(1).to_pylist()
                if not items:
                    continue
                order, highest = index.bounds(index.lifted([i[8:] for i in items], query=True))
                before = np.cumsum(index.held[order], axis=1) - index.held[order]
                seen = before < enough
                least = None if first else np.array([float("-inf") if s is None else s
                                                     for s in batch.column(2).to_pylist()])
                take = (seen if first else ~seen & (highest >= least[:, None])) & (index.held[order] > 0)
                at, rank = np.nonzero(take)
                yield pa.RecordBatch.from_pydict({
                    "annulus": pa.array(order[at, rank], pa.int32()), "vec_id": batch.column(0).take(pa.array(at)),
                    "item": batch.column(1).take(pa.array(at))})

        return chosen

    def scan(routed: DataFrame) -> DataFrame:
        blocks = _blocks(staged(routed, "top_k_routed"), QUERY_BLOCK, "queries")
        scored = blocks.join(data, "annulus").select(F.explode(_score(index.dim, k)).alias("f")).select("f.*")
        return staged(_best(scored, k).select("query_id", "vec_id", "score"), "top_k_found")

    wanted = "annulus int, vec_id long, item binary"
    near = scan(queries.mapInArrow(route(True), wanted))
    worst = near.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")) \
        .select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least")).alias("least"))
    rest = queries.join(worst, "vec_id", "left").select("vec_id", "item", "least")
    far = scan(rest.mapInArrow(route(False), wanted))
    return _best(near.unionByName(far), k).select("query_id", "rank", "vec_id", "score")
