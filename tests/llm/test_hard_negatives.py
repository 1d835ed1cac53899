"""Hard negatives against a scan of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aurum.llm import hard_negatives

VECTORS = "vec_id long, embedding array<float>, label int, slot int, limits string, cell int, score int, windows int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", 0, 0, 0) for r in rows], VECTORS)


def plain(rows, low=80, high=100, n_positives=5, k=5, scale=256):
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(scale * float(np.float32(c))) for c in v]
        mine = (label, np.array(x, "<i4").tobytes(), x)
        usable[i] = max(usable.get(i, mine), mine)
    out = []
    for a, (label, _, v) in usable.items():
        if a % 100:
            continue
        scored = sorted((-sum(s * t for s, t in zip(v, w)), i, other) for i, (other, _, w) in usable.items() if i != a)
        positives = [(i, -s) for s, i, other in scored if other == label][:n_positives]
        for p, score in positives:
            fits = [(i, -s) for s, i, other in scored if other != label and low * score <= -100 * s <= high * score]
            out += [(a, p, r, n, score, s) for r, (n, s) in enumerate(fits[:k], 1)]
    return sorted(out)


def found(df, **how):
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def some_rows():
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * 0.4 + 0.5).astype("f4").tolist(), int(rng.integers(0, 3))) for i in range(420)]
    rows += [(500 + i, rows[100][1], i % 2) for i in range(40)]                      # ties, inside and across labels
    rows += [(600, [0.0] * 6, 1), (700, [-1.0] * 6, 0), (800, [1.0] * 3, 2), (801, [], 2), (900, [0.5] * 6, 77)]
    rows += [(1000, None, 1), (1001, [1.0, None], 1), (1002, [float("nan")] * 6, 1), (1003, [float("inf")] * 6, 1),
             (1004, [1.0] * 6, None), (None, [1.0] * 6, 1), (300, [0.9] * 6, 2), (300, [0.9] * 6, 2)]
    return rows


@pytest.mark.parametrize("how", [{}, {"low_percent": 50, "high_percent": 90, "n_positives": 2, "k": 3}])
def test_negatives_are_those_of_all_pairs(spark, monkeypatch, how):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 16 * 40)                      # many blocks
    rows = some_rows()
    want = plain(rows, how.get("low_percent", 80), how.get("high_percent", 100), how.get("n_positives", 5), how.get("k", 5))
    assert len(want) > 30
    assert found(frame(spark, rows).repartition(5), **how) == want


def test_one_block_and_another_label(spark):
    rows = some_rows()
    other = [(i, v, label if i is None or label is None else (i * 7) % 4) for i, v, label in rows]
    df = frame(spark, rows)
    label = F.when(F.col("label").isNotNull(), (F.col("vec_id") * 7) % 4)
    assert found(df, label=label) == plain(other)


def test_equal_limits_share_a_slot(spark):
    rows = [(0, [1.0], 0)] + [(i, [1.0], 0) for i in range(1, 8)] + [(i, [1.0 if i % 2 else 0.9], 1) for i in range(8, 30)]
    got = found(frame(spark, rows))
    assert got == plain(rows) and {r[1] for r in got} == {1, 2, 3, 4, 5} and {r[3] for r in got} == {9, 11, 13, 15, 17}


def test_few_or_no_rows(spark):
    assert found(frame(spark, some_rows()).limit(0)) == []
    alone = [(0, [1.0, 2.0], 0), (5, [2.0, 0.5], 1)]
    assert found(frame(spark, alone)) == []                                          # no positive
    assert found(frame(spark, [(0, [1.0], 0), (1, [1.0], 0)])) == []                 # no negative
    assert found(frame(spark, [(0, [], 0), (1, [], 0), (2, [], 1)])) == [(0, 1, 1, 2, 0, 0)]


def test_components_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="out of range"):
        found(frame(spark, [(0, [3e9], 0), (1, [1.0], 0)]))


def scanned(ids, labels, q, limits, floors, rows, k, same_label):
    out = []
    for i, label, v, limit, floor in zip(ids, labels, q, limits, floors, strict=True):
        for j, (top, low) in enumerate(zip(limit, floor, strict=True)):
            if j + 1 < len(limit):
                low = max(int(low), int(limit[j + 1]) + 1)
            scored = sorted((-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), r) for r, other, w in rows
                            if r != i and (other == label) == same_label)
            out += [(int(i), j, int(r), -s) for s, r in [x for x in scored if low <= -x[0] <= top][:k]]
    return sorted(out)


@pytest.mark.parametrize("kind", ["plain", "amid", "copies", "labels", "large", "huge"])
@pytest.mark.parametrize("same_label", [True, False])
def test_a_cell_keeps_the_best_of_every_slot(monkeypatch, kind, same_label):
    for name, value in (("ANCHORS", 7), ("ROWS", 32), ("FIRST_ROWS", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(5)
    n, dim, reach = 300, 5, {"large": 2**13, "huge": 2**29}.get(kind, 40)
    x = rng.integers(-reach, reach, (n, dim)).astype("<i4")
    if kind == "copies":
        x[rng.random(n) < 0.5] = x[0]
    ids = rng.permutation(n).astype(np.int64) * 3
    labels = rng.integers(0, 100 if kind == "labels" else 4, n)
    anchors = rng.choice(n, 25, replace=False)
    anchors = anchors[np.argsort(labels[anchors], kind="stable")]
    scores = np.sort(x[anchors].astype(np.int64) @ x.T.astype(np.int64), axis=1)
    at = (0.3, 0.4, 0.5, 0.5, 0.9) if kind == "amid" else (0.002, 0.02, 0.1, 0.1, 0.3)
    limits = np.stack([scores[:, int((n - 1) * (1 - a))] for a in at], axis=1)
    lows = np.where(limits > 0, limits * 4 // 5, limits)
    floors = hard_negatives._floors(limits, lows)
    if same_label:
        limits, floors = np.full((25, 1), 2**63 - 1), np.full((25, 1), -2**63)
    half = n // 2
    cell = hard_negatives._Cell([(ids[:half], labels[:half], x[:half]), (ids[half:], labels[half:], x[half:])], same_label)
    got = [tuple(map(int, r)) for found in cell.best(ids[anchors], labels[anchors], x[anchors], limits, floors, 3)
           for r in zip(*found, strict=True)]
    want = scanned(ids[anchors], labels[anchors], x[anchors], limits, floors, list(zip(ids, labels, x, strict=True)), 3, same_label)
    assert sorted(got) == want and len(want) > 20


def test_many_labels_common_vectors_and_shorter_ones(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 16 * 60)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=4) * 0.5).astype("f4").tolist(), int(rng.integers(0, 150))) for i in range(600)]
    rows += [(700 + i, rows[100][1], i % 3) for i in range(150)] + [(900 + i, [0.7] * (i % 5), i % 2) for i in range(60)]
    want = plain(rows)
    assert len(want) > 50 and found(frame(spark, rows).repartition(3)) == want


def test_vectors_meet_in_cells_of_a_task(spark, monkeypatch):
    """No product leaves its pair of blocks to Python one by one, and unique ids are not shuffled to be compared."""
    plans = []
    staged = hard_negatives.staged

    def seen(df, name, **how):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return staged(df, name, **how)

    monkeypatch.setattr(hard_negatives, "staged", seen)
    rows = [r for r in some_rows() if r[0] != 300]
    assert found(frame(spark, rows)) == plain(rows)
    assert [name for name, _ in plans] == ["negatives_vectors", "negatives_slots", "negatives_windows", "negatives_slots"]
    assert not any("BatchEvalPython" in plan or "collect_list(item" in plan for _, plan in plans)
    assert "Exchange" not in plans[0][1]
    # 6 GB of documents go with some 615,000 vectors: a scan of them by cells, not by thousands of pairs of blocks
    assert hard_negatives._parts(spark, 615_384, 64) <= max(3, 2 * spark.sparkContext.defaultParallelism)
    assert hard_negatives._parts(spark, 15_000_000, 64) <= 80 and hard_negatives._parts(spark, 0, 64) == 1
