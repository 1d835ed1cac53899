"""Hard negatives by slot-decomposed selection.

An anchor's positives are its ``n_positives`` best rows of the same label.  A positive of score ``p`` opens a window
of scores, ``low_percent * p <= 100 * score <= high_percent * p``, and wants the best ``k`` rows of other labels in it.
The windows of one anchor overlap, so they are not searched one by one.  Their upper limits, in descending order, cut
all scores into disjoint slots: slot j holds the scores from limit j down to just above limit j + 1.  Each scored row
falls into one slot.  The best k of a slot are kept wherever rows meet: in each cell of rows, in each task before
the shuffle, and once more behind it.  The best k rows up to limit j are then those of the slots j, j + 1, ... merged
from the last slot upwards, each merge keeping k; a window takes those of its own suffix that reach its lower limit.

Scores are exact integer inner products of ``floor(scale * x)``.  The rows are shuffled once for the positives and once
for the negatives, into cells of about ``BLOCK_BYTES`` at most; a task holds one cell and the anchors stream past it.  A cell
takes rows by a hash of the id, so neither a label with a third of all rows nor many equal vectors fill one task, and
every anchor goes to every cell: copies of anchors grow with the number of cells, not with that of smaller blocks.  For
the positives a label with few rows goes to one cell as a whole, and so do its anchors.  The work is that of a scan of
all pairs, by matrix products: a score is compared once with its anchor's lower bound, and only what reaches it is
looked at further.  The bound starts at the anchor's windows and rises with the k-th best row met in each slot, in
ascending order of the ids, so that a tie with it can be left out.  At most ``n_positives * k`` rows an anchor leave a
cell, and the selection.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part.  Of rows that
repeat an id, the one with the largest (label, vector in byte order) counts.  Shorter vectors count as padded with
zeros.  Ties go to the smaller id, for positives and negatives.  A window whose lower limit exceeds its upper limit
(a negative positive score) is empty, and a positive without a row in its window gives no row.  Components beyond a
32-bit integer after scaling, or products beyond a 64-bit one, are an error.  An empty table gives none.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum.llm.common import staged
from aurum.session import small_batches

SCALE = 256
K = 5
POSITIVES = 5
#: Bytes of the rows that a task holds, and those below which a cell is not made smaller to occupy more cores.
BLOCK_BYTES = 64 << 20
LEAST_BYTES = 1 << 19
#: Anchors and rows of one matrix product; the products of a cell begin with fewer rows, to learn the bounds.
ANCHORS, ROWS, FIRST_ROWS = 256, 2048, 64
#: Labels with more than this share of a cell's rows are spread over all cells.
LARGE_SHARE = 8

_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_FOUND = "anchor_id bigint, slot int, vec_id bigint, score bigint"


def quantised(rows: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """The rows that take part: ``vec_id, label, vec`` (packed little-endian 32-bit integers) and ``dim``; staged."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            ends = np.r_[0, np.cumsum(sizes)]
            usable = np.diff(np.r_[0, np.cumsum(~np.isfinite(x))][ends]) == 0
            x, sizes = x[np.repeat(usable, sizes)], sizes[usable]
            kept = batch.select(["vec_id", "label"]).filter(pa.array(usable))
            if len(far := np.flatnonzero(np.abs(x) >= 2**31)):
                at = int(np.searchsorted(np.cumsum(sizes), far[0], "right"))
                raise ValueError(f"vector {kept.column('vec_id')[at]}: a component is out of range")
            ends = np.r_[0, np.cumsum(4 * sizes)].astype(np.int32)
            vecs = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(x.astype("<i4"))])
            yield pa.RecordBatch.from_arrays([*kept.columns, vecs, pa.array(sizes, pa.int32())],
                                             names=["vec_id", "label", "vec", "dim"])

    small_batches(rows.sparkSession)
    kind = "array<float>" if rows.select("embedding").dtypes[0][1] == "array<float>" else "array<double>"
    used = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                       F.col("embedding").cast(kind).alias("vector")) \
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    packed = staged(used.mapInArrow(pack, "vec_id long, label long, vec binary, dim int"), "negatives_vectors")
    if packed.select("vec_id").distinct().count() == packed.count():
        return packed
    one = packed.groupBy("vec_id").agg(F.max(F.struct("label", "vec", "dim")).alias("r"))
    return staged(one.select("vec_id", "r.*"), "negatives_vectors")


def _parts(spark: SparkSession, rows: int, dim: int) -> int:
    """The number of cells: each of ``BLOCK_BYTES`` at most, and whole rounds of all cores if there are enough rows."""
    each, cores = 4 * dim + 16, max(1, spark.sparkContext.defaultParallelism)
    fewest = -(-rows // max(16, BLOCK_BYTES // each))
    return max(1, fewest, min(cores * max(2, -(-fewest // cores)), -(-rows * each // LEAST_BYTES)))


def _arrays(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and padded vectors."""
    vecs = batch.column("vec").cast(pa.binary())
    ends = np.frombuffer(vecs.buffers()[1], np.int32)[vecs.offset:vecs.offset + len(vecs) + 1] // 4
    flat = np.frombuffer(vecs.buffers()[2] or b"", "<i4")[ends[0]:ends[-1]]
    sizes = np.diff(ends)
    if (sizes == dim).all():
        x = flat.reshape(len(vecs), dim)
    else:
        x = np.zeros((len(vecs), dim), "<i4")
        x[np.arange(dim) < sizes[:, None]] = flat
    return batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), x


def _longest(x: np.ndarray) -> float:
    """The largest Euclidean norm: products of it bound every partial sum of an inner product."""
    return float(np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64).max(initial=0)))


def _steps(n: int) -> list[tuple[int, int]]:
    """Ranges of rows for the products of a cell: ``FIRST_ROWS`` and twice as many each time, up to ``ROWS``."""
    out, at, size = [], 0, FIRST_ROWS
    while at < n:
        out.append((at, min(n, at + size)))
        at, size = at + size, min(ROWS, 2 * size)
    return out


def _first(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The best k of each group of ``group, score, id``, sorted; and the places at which a k-th one stands."""
    group, score, ids = found
    order = np.lexsort((ids, -score, group))
    group = group[order]
    first = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
    place = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    order, place = order[place < k], place[place < k]
    return found[0][order], score[order], ids[order], place == k - 1


def _best(ids: np.ndarray, q: np.ndarray, limits: np.ndarray, floors: np.ndarray, row_ids: np.ndarray, x: np.ndarray,
          own: list, k: int, longest: float) -> tuple[np.ndarray, ...]:
    """``anchor, slot, id, score`` of the best k rows of every slot; ``own[i]`` lists what step i leaves out.

    A row of a slot has a score from ``floors`` to ``limits``.  Ids of later steps are larger than those of earlier ones.
    """
    most = int(longest) + 1
    exact = np.float32 if most < 2**24 - 4 else np.float64 if most < 2**53 - 4 else np.int64
    if most >= 2**63 - 2**12:
        raise ValueError("scores are out of range")
    n_slots, floors = limits.shape[1], floors.copy()
    q, never = q.astype(exact), np.iinfo(np.int64).min if exact is np.int64 else -np.inf
    held, marks = np.empty(len(q) * ROWS, exact), np.empty(len(q) * ROWS, bool)
    none = np.zeros(0, np.int64)
    found, new, n_new = (none, none, none), [], 0

    def typed(bounds: np.ndarray) -> np.ndarray:
        return np.clip(bounds, -most - 1, most + 1).astype(exact)[:, None]

    lowest = typed(np.where(floors <= limits, floors, _MOST).min(1))
    for (lo, hi), left_out in zip(_steps(len(x)), own, strict=True):
        scores = np.matmul(q, x[lo:hi].astype(exact).T, out=held[:len(q) * (hi - lo)].reshape(len(q), hi - lo))
        for a0, a1, x0, x1 in left_out:
            scores[a0:a1, x0:x1] = never
        near = np.greater_equal(scores, lowest, out=marks[:scores.size].reshape(scores.shape))
        if np.count_nonzero(near) > near.size // 16:  # windows amid most scores: slot by slot
            near[:] = False
            for j in range(n_slots):
                near |= (scores >= typed(floors[:, j])) & (scores <= typed(limits[:, j]))
        at = np.flatnonzero(near)
        if not len(at):
            continue
        anchor, row = np.divmod(at, hi - lo)
        score, row = scores.reshape(-1)[at].astype(np.int64), row_ids[lo + row]
        slot = (limits[anchor] >= score[:, None]).sum(1) - 1
        good = (slot >= 0) & (score >= floors[anchor, slot]) & (ids[anchor] != row)
        new.append(((anchor * n_slots + slot)[good], score[good], row[good]))
        n_new += len(new[-1][0])
        if n_new > len(q) * k:
            *found, kth = _first(tuple(map(np.concatenate, zip(found, *new, strict=True))), k)
            new, n_new = [], 0
            floors.reshape(-1)[found[0][kth]] = found[1][kth] + 1  # a tie has a larger id
            lowest = typed(np.where(floors <= limits, floors, _MOST).min(1))
    group, score, row, _ = _first(tuple(map(np.concatenate, zip(found, *new, strict=True))), k)
    return group // n_slots, group % n_slots, row, score


class _Cell:
    """The rows of a cell, which anchors stream past."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], same_label: bool) -> None:
        ids, labels = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
        if same_label:
            order = np.lexsort((ids, labels))
        else:  # ids ascend from step to step, labels within a step
            order = np.argsort(ids, kind="stable")
            step = np.repeat(np.arange(len(_steps(len(ids)))), [hi - lo for lo, hi in _steps(len(ids))])
            order = order[np.lexsort((labels[order], step))]
        self.same_label, self.ids, self.labels = same_label, ids[order], labels[order]
        self.x = np.concatenate([r[2] for r in rows])[order]
        self.longest = _longest(self.x)

    def best(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, limits: np.ndarray, floors: np.ndarray,
             k: int) -> Iterator[tuple[np.ndarray, ...]]:
        """``anchor_id, slot, vec_id, score`` for blocks of anchors sorted by label."""
        longest = self.longest * _longest(q) * (1 + 1e-6)
        cuts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True])
        if self.same_label:
            runs = [(a, min(a + ANCHORS, a1)) for a0, a1 in zip(cuts[:-1], cuts[1:], strict=True) for a in range(a0, a1, ANCHORS)]
        else:
            runs = [(a, min(a + ANCHORS, len(ids))) for a in range(0, len(ids), ANCHORS)]
        for a0, a1 in runs:
            lo, hi, own = 0, len(self.ids), None
            if self.same_label:
                lo, hi = np.searchsorted(self.labels, labels[a0], "left"), np.searchsorted(self.labels, labels[a0], "right")
                own = [()] * len(_steps(hi - lo))
            else:
                own = [self._same(labels[a0:a1], self.labels[x0:x1]) for x0, x1 in _steps(hi)]
            if lo < hi:
                anchor, slot, row, score = _best(ids[a0:a1], q[a0:a1], limits[a0:a1], floors[a0:a1], self.ids[lo:hi],
                                                 self.x[lo:hi], own, k, longest)
                yield ids[a0 + anchor], slot, row, score

    @staticmethod
    def _same(labels: np.ndarray, row_labels: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The ranges of anchors and rows of equal label, both sorted by it."""
        cuts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True])
        lows, highs = (np.searchsorted(row_labels, labels[cuts[:-1]], side) for side in ("left", "right"))
        return [(a0, a1, lo, hi) for a0, a1, lo, hi in zip(cuts[:-1], cuts[1:], lows, highs, strict=True) if lo < hi]


def _floors(limits: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """The least score of each slot that a window reaching it can want; above its limit if there is none."""
    wanted = np.minimum.accumulate(np.where(lows <= limits, lows, _MOST), axis=1)
    wanted[:, :-1] = np.maximum(wanted[:, :-1], limits[:, 1:] + 1)
    return wanted


def _selected(anchors: DataFrame, rows: DataFrame, dim: int, n_slots: int, k: int, same_label: bool) -> DataFrame:
    """``anchor_id, slot, vec_id, score``: the best k rows of every slot, of the anchor's label or of all others; staged.

    ``anchors`` has ``limits`` and ``lows`` of ``n_slots`` windows each; for rows of the same label they are not read.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, cell = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1]), True]).tolist()
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                piece = batch.slice(lo, hi - lo)
                if parts[lo] != part:
                    part, held, cell = parts[lo], [], None
                if kinds[lo] == 0:
                    held.append(_arrays(piece, dim))
                    continue
                if held:
                    cell, held = _Cell(held, same_label), []
                if cell is None:
                    continue
                ids, labels, q = _arrays(piece, dim)
                order = np.argsort(labels, kind="stable")
                if same_label:
                    limits, floors = np.full((len(ids), 1), _MOST), np.full((len(ids), 1), _LEAST)
                else:
                    limits, lows = (piece.column(c).flatten().to_numpy().reshape(-1, n_slots) for c in ("limits", "lows"))
                    floors = _floors(limits, lows)
                found = list(cell.best(ids[order], labels[order], q[order], limits[order], floors[order], k))
                if found:
                    kinds_out = (np.int64, np.int32, np.int64, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t)) for c, t in zip(zip(*found, strict=True), kinds_out, strict=True)],
                                                     names=["anchor_id", "slot", "vec_id", "score"])

    spark = rows.sparkSession
    small_batches(spark)
    n = rows.count()
    parts = _parts(spark, n, dim)
    home = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    reach = F.sequence(F.lit(0), F.lit(parts - 1))
    if same_label and parts > 1:
        counts = rows.groupBy("label").count().where(F.col("count") > n / (LARGE_SHARE * parts))
        large = F.col("label").isin([r[0] for r in counts.select("label").collect()])  # LARGE_SHARE * parts at most
        whole = F.pmod(F.xxhash64("label"), F.lit(parts)).cast("int")
        home, reach = F.when(large, home).otherwise(whole), F.when(large, reach).otherwise(F.array(whole))
    no_limits = F.array().cast("array<bigint>")  # not null: runs of nulls are slow to put into an Arrow batch
    held = rows.select(home.alias("part"), F.lit(0).alias("kind"), "vec_id", "label", "vec", no_limits.alias("limits"),
                       no_limits.alias("lows"))
    asked = anchors.select("vec_id", "label", "vec", *(("limits", "lows") if not same_label else ())).repartition(parts)
    sent = asked.select(F.explode(reach).alias("part"), F.lit(1).alias("kind"), "vec_id", "label", "vec",
                        *((no_limits.alias("limits"), no_limits.alias("lows")) if same_label else ("limits", "lows")))
    found = held.union(sent).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind").mapInArrow(search, _FOUND)
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    kept = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")
    return staged(kept, "negatives_slots")


def mine(rows: DataFrame, is_anchor: Column, label: Column | None = None, n_positives: int = POSITIVES, k: int = K,
         low_percent: int = 80, high_percent: int = 100, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor and positive.

    ``rows`` has ``vec_id``, ``embedding`` and (without ``label``) ``label``; ``is_anchor`` and ``label`` are
    expressions over them, ``is_anchor`` over ``vec_id`` and the resulting ``label`` only.
    """
    spark = rows.sparkSession
    vectors = quantised(rows, F.col("label") if label is None else label, scale)
    dim = vectors.agg(F.max("dim")).first()[0]
    if not dim:
        dim = 1
    anchors = vectors.where(is_anchor)
    positives = _selected(anchors, vectors, dim, 1, n_positives, same_label=True)

    # a window's limits are whole scores; limits descend, and short lists repeat the last one
    window = F.expr(f"""struct(score AS positive_score, vec_id AS positive_id,
        cast(floor(cast(score AS decimal(38, 0)) * {high_percent} / 100) AS bigint) AS high,
        cast(ceil(cast(score AS decimal(38, 0)) * {low_percent} / 100) AS bigint) AS low)""")
    by_limit = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(window), asc=False).alias("windows"))
    padded = f"transform(sequence(0, {n_positives} - 1), i -> windows[least(i, size(windows) - 1)].{{}})"
    by_limit = staged(by_limit.withColumn("limits", F.expr(padded.format("high")))
                      .withColumn("lows", F.expr(padded.format("low"))), "negatives_windows")
    asked = anchors.join(by_limit.where("exists(windows, w -> w.low <= w.high)")
                         .select(F.col("anchor_id").alias("vec_id"), "limits", "lows"), "vec_id")
    slots = _selected(asked, vectors, dim, n_positives, k, same_label=False)

    # suffixes[j]: the best k up to limit j, merged from the last slot upwards
    none_yet = "cast(array() AS array<struct<down: bigint, vec_id: bigint, slot: int>>)"
    suffixes = f"""aggregate(sequence(0, {n_positives} - 1),
        cast(array() AS array<array<struct<down: bigint, vec_id: bigint, slot: int>>>),
        (merged, i) -> array_append(merged, slice(array_sort(concat(
            if(i = 0, {none_yet}, element_at(merged, -1)),
            filter(found, f -> f.slot = {n_positives} - 1 - i))), 1, {k})),
        merged -> reverse(merged))"""
    found = slots.groupBy("anchor_id").agg(
        F.collect_list(F.expr("struct(-score AS down, vec_id, slot)")).alias("found"))
    answered = by_limit.join(found, "anchor_id").withColumn("suffixes", F.expr(suffixes)) \
        .select("anchor_id", "limits", "suffixes", F.explode("windows").alias("w"))
    # the first suffix whose limit is the window's own
    own = "suffixes[cast(array_position(limits, w.high) - 1 AS int)]"
    return answered.select("anchor_id", "w", F.posexplode(F.expr(f"filter({own}, f -> -f.down >= w.low)"))) \
        .select("anchor_id", F.col("w.positive_id").alias("positive_id"), (F.col("pos") + 1).cast("int").alias("rank"),
                F.col("col.vec_id").alias("negative_id"), F.col("w.positive_score").alias("positive_score"),
                (-F.col("col.down")).alias("negative_score"))
