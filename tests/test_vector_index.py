import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aurum.operators import vector_index as I
from aurum.operators import vectors as V

BASE = "vec_id bigint, embedding array<double>"


def clustered(n=1500, dims=8, clusters=12, seed=5):
    """Vectors around a few centres; one vector with very many copies, ties among them."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, dims)) * 10
    rows = [(i, (centre[i % clusters] + rng.normal(size=dims) * .2).tolist()) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(n // 3)]


def both(spark, path, rows, asked, metric, k=5, dims=8):
    df = spark.createDataFrame(rows, BASE)
    queries = spark.createDataFrame(asked, "qid bigint, qvec array<double>")
    I.build(df, path, dims, metric, rows=64)
    got, share = I.search(spark, path, queries, k, exclude_self=True)
    ok = F.coalesce((F.size("embedding") == dims) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
    asked_ok = F.coalesce((F.size("qvec") == dims) & F.forall("qvec", lambda x: x.isNotNull()), F.lit(False))
    want = V.top_k(df.where(ok), queries.where(asked_ok), k, metric=metric, exclude_self=True)

    def in_order(frame):
        return sorted((r.qid, r["rank"], r.vec_id, round(r.score, 9)) for r in frame.collect())

    assert in_order(got) == in_order(want)
    return share


@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
def test_results_are_those_of_all_pairs_and_cells_are_excluded(spark, scratch, metric):
    rows = clustered()
    share = both(spark, f"{scratch}/{metric}", rows, rows[::40], metric)
    assert 0 < share < .5
    assert spark.read.parquet(f"{scratch}/{metric}/blocks").agg(F.max(F.size("ids"))).first()[0] < 200   # copies in many blocks


def test_vectors_without_clusters_are_found_as_well(spark, scratch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    assert 0 < both(spark, f"{scratch}/r", rows, rows[::50], "dot") <= 1


def test_fewer_rows_than_asked_for_odd_rows_and_none(spark, scratch):
    odd = [(1, [1.0] * 8), (2, None), (3, [1.0] * 7), (4, [float("nan")] * 8), (None, [2.0] * 8), (5, [None] + [1.0] * 7)]
    df = spark.createDataFrame(odd, BASE)
    queries = spark.createDataFrame([(1, [1.0] * 8), (9, [3.0] * 8), (10, None), (11, [1.0])], "qid bigint, qvec array<double>")
    I.build(df, f"{scratch}/odd", 8)
    got, share = I.search(spark, f"{scratch}/odd", queries, 5, exclude_self=True)
    assert [(r.qid, r.vec_id, r.score, r["rank"]) for r in got.collect()] == [(9, 1, 24.0, 1)] and share == 1
    I.build(df.limit(0), f"{scratch}/none", 8)
    got, share = I.search(spark, f"{scratch}/none", queries, 5)
    assert got.count() == 0 and share == 0
    with pytest.raises(ValueError, match="unknown metric"):
        I.build(df, f"{scratch}/x", 8, metric="hamming")


def test_queries_that_ask_for_every_cell_are_handed_on_in_pieces():
    queries, cells = 128, 4096
    batch = pa.RecordBatch.from_arrays([pa.array(range(queries)), pa.array([[float(i)] * 4 for i in range(queries)])], names=["id", "v"])
    at, cell = np.repeat(np.arange(queries), cells), np.tile(np.arange(cells, dtype=np.int32), queries)
    seen = 0
    for piece in I._pairs(batch, at, cell):
        assert piece.num_rows <= I.PAIRS_AT_ONCE
        seen += piece.num_rows
    assert seen == queries * cells
    assert list(I._pairs(batch, at[:0], cell[:0])) == []
    assert piece.column("id")[-1].as_py() == queries - 1 and piece.column("v")[-1].as_py() == [queries - 1.0] * 4
    assert piece.column("cell")[-1].as_py() == cells - 1
