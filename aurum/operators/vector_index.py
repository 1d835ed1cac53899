"""A stored index for exact top-k search: cells of vectors whose stated bounds exclude them before they are scored.

``build`` keys every vector by its nearest centre and writes the cells in blocks of about ``BASE_BLOCK`` rows (a cell
with many rows, of copies say, has many blocks), with a row for each cell: its centre, its number of rows and its
radius, the largest distance of a row from the centre.  By the triangle inequality no row of a cell is nearer to a
query than the centre's distance less the radius, and no inner product is larger than the centre's plus the radius
times the query's length.  ``search`` scores the most promising cells first, which gives each query a k-th score, and then only
those cells whose bound reaches it.  The results are those of scoring all rows (``vectors.top_k``); how many pairs that
takes depends on how far the vectors cluster, and ``search`` tells the share.

The centres are at most ``CENTRES`` rows, those of smallest hash of the id, so what tasks hold of the cells is bounded.
Refused are rows with a null id or vector, another dimension or a component that is not finite, and for the cosine
rows of length zero; queries alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum.operators.joins import materialised
from aurum.operators.vectors import BASE_BLOCK, METRICS, QUERY_BLOCK, block_top_k, norm

CENTRES = 4096
#: Relative room for rounding in a bound.
ROOM = 1e-9
#: Rows that a task compares with all centres at a time.
AT_ONCE = 128
#: Pairs of a query and a cell, each with the query's vector, that a task hands on at a time.
PAIRS_AT_ONCE = 4096


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(start, AT_ONCE)


def _rows(df: DataFrame, id_col: str, vec_col: str, dims: int, metric: str) -> DataFrame:
    """``id, v``: the rows that an index of ``dims`` takes."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.coalesce((F.size("v") == dims) & finite, F.lit(False)))
    return rows.where(norm(F.col("v")) > 0) if metric == "cosine" else rows


def _matrix(column: pa.Array, dims: int, metric: str) -> np.ndarray:
    """The vectors of a column; of length one for the cosine, whose geometry is that of the sphere."""
    out = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return out / np.linalg.norm(out, axis=1, keepdims=True) if metric == "cosine" else out


def _distances(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(n x d), (m x d) -> (n x m), without the cancellation of the expanded square."""
    out = np.empty((len(v), len(centres)))
    for i, row in enumerate(v):
        out[i] = np.sqrt(((centres - row) ** 2).sum(axis=1))
    return out


def build(df: DataFrame, path: str, dims: int, metric: str = "dot", id_col: str = "vec_id", vec_col: str = "embedding",
          rows: int = BASE_BLOCK) -> None:
    """Write the index of ``df`` under ``path``: ``cells``, ``blocks`` and ``kind`` (metric and dimension)."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    spark = df.sparkSession
    base = _rows(df, id_col, vec_col, dims, metric)
    n_cells = min(CENTRES, max(1, math.ceil(base.count() / rows)))
    chosen = [r.v for r in base.orderBy(F.xxhash64("id"), "id", "v").limit(n_cells).collect()]  # bounded by CENTRES
    centres = np.array(chosen, float).reshape(-1, dims)
    if metric == "cosine":
        centres = centres / np.linalg.norm(centres, axis=1, keepdims=True)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            far = _distances(_matrix(batch.column(1), dims, metric), centres)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(far.argmin(axis=1), pa.int32()), pa.array(far.min(axis=1))],
                names=["id", "v", "cell", "distance"])

    placed = materialised(base.mapInArrow(nearest, "id bigint, v array<double>, cell int, distance double"), "vector_cells")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"))
    centre = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    sizes.join(F.broadcast(centre), "cell").write.parquet(f"{path}/cells")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / rows)).alias("part")
    placed.join(F.broadcast(sizes.select("cell", "n")), "cell").groupBy("cell", part) \
        .agg(F.collect_list(F.struct("id", "v")).alias("r")).select("cell", F.col("r.id").alias("ids"), F.col("r.v").alias("vecs")) \
        .write.parquet(f"{path}/blocks")
    spark.createDataFrame([(metric, dims)], "metric string, dims int").write.parquet(f"{path}/kind")


def _pairs(batch: pa.RecordBatch, at: np.ndarray, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``id, v, cell``: the rows ``at`` of a batch, each with its cell; in pieces, as a query may ask for every cell."""
    for start in range(0, len(at), PAIRS_AT_ONCE):
        take = pa.array(at[start:start + PAIRS_AT_ONCE], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take),
                                          pa.array(cell[start:start + PAIRS_AT_ONCE])], names=["id", "v", "cell"])


def _cells_asked(queries: DataFrame, cells: list, k: int, dims: int, metric: str, first: bool) -> DataFrame:
    """``id, v, cell``: the cells that each query scores first, or all others whose bound reaches its ``kth`` score."""
    number = np.array([c.cell for c in cells], np.int32)
    held, radius = np.array([c.n for c in cells], np.int64), np.array([c.radius for c in cells], float)
    centres = np.array([c.centre for c in cells], float).reshape(-1, dims)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches) if cells else ():
            q = _matrix(batch.column(1), dims, metric)
            if metric == "l2":  # bounds as scores of which the larger are the better
                bound = radius - _distances(q, centres)
                room = ROOM * (1 + radius + np.abs(bound))
            else:
                reach = np.linalg.norm(q, axis=1, keepdims=True) * radius
                bound = q @ centres.T + reach
                room = ROOM * (1 + reach + np.abs(bound))
            order = np.argsort(-bound, axis=1, kind="stable")
            enough = np.cumsum(held[order], axis=1) - held[order] <= k  # k rows besides the query itself
            at, col = np.nonzero(enough if first else ~enough)
            col = order[at, col]
            if not first:
                kth = batch.column(2).to_numpy(zero_copy_only=False).astype(float)  # null: not k rows so far
                kth = -kth if metric == "l2" else kth
                reached = ~((bound + room)[at, col] < kth[at])
                at, col = at[reached], col[reached]
            yield from _pairs(batch, at, number[col])

    return queries.mapInArrow(asked, "id bigint, v array<double>, cell int")


def _scored(blocks: DataFrame, wanted: DataFrame, n_queries: int, k: int, metric: str, exclude_self: bool) -> DataFrame:
    """``q, i, s``: the best k rows of each block for each query that asks for its cell; queries in blocks of their own."""
    part = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(n_queries / QUERY_BLOCK)))).alias("part")
    sent = wanted.groupBy("cell", part).agg(F.collect_list(F.struct("id", "v")).alias("r")) \
        .select("cell", F.col("r.id").alias("qids"), F.col("r.v").alias("qvecs"))
    return block_top_k(blocks.join(sent, "cell"), k, metric, exclude_self)


def _best(found: DataFrame, k: int, metric: str) -> DataFrame:
    order: Column = F.col("s").asc() if metric == "l2" else F.col("s").desc()
    w = Window.partitionBy("q").orderBy(order, F.col("i").asc())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, qid_col: str = "qid", qvec_col: str = "qvec",
           id_col: str = "vec_id", exclude_self: bool = False) -> tuple[DataFrame, float]:
    """The ``k`` best rows of every query, ``(qid, id, score, rank)`` as ``vectors.top_k`` gives them, and the share of
    all pairs of queries and rows that was scored (0 without any).  Query ids are distinct."""
    kind = spark.read.parquet(f"{path}/kind").first()
    metric, dims = kind["metric"], kind["dims"]
    cells = spark.read.schema("cell int, n bigint, radius double, centre array<double>").parquet(f"{path}/cells") \
        .orderBy("cell").collect()  # at most CENTRES rows
    blocks = spark.read.schema("cell int, ids array<bigint>, vecs array<array<double>>").parquet(f"{path}/blocks")
    asked = materialised(_rows(queries, qid_col, qvec_col, dims, metric), "vector_queries")
    n_queries = asked.count()
    first = materialised(_cells_asked(asked, cells, k, dims, metric, True), "vector_first")
    found = materialised(_best(_scored(blocks, first, n_queries, k, metric, exclude_self), k, metric), "vector_found")
    kth = asked.join(found.where(F.col("rank") == k).select(F.col("q").alias("id"), F.col("s").alias("kth")), "id", "left")
    others = materialised(_cells_asked(kth.select("id", "v", "kth"), cells, k, dims, metric, False), "vector_others")
    more = _scored(blocks, others, n_queries, k, metric, exclude_self)
    result = _best(found.drop("rank").unionByName(more), k, metric).select(
        F.col("q").alias(qid_col), F.col("i").alias(id_col), F.col("s").alias("score"), "rank")
    held = {c.cell: c.n for c in cells}
    scored = sum(r["count"] * held[r.cell] for r in first.unionByName(others).groupBy("cell").count().collect())
    pairs = n_queries * sum(held.values())
    return result, scored / pairs if pairs else 0.0
