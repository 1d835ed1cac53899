"""Mixing sources to target weights by subset-sum budget fitting.

The sources, ordered by code point with null last, get the weights in turn and share ``share`` times the words of all
documents.  A target stops at ``most`` times its source's size and what is above is shared again by weight (one pass
over the sources in order of size by weight finds that state).  For each source the documents are counted by exact
length.  Whole rounds of the source come first; the rest of the budget is filled from the counts: all but the last
``DP_BUDGET`` words proportionally over all lengths (what rounding leaves, by longest lengths), and those by a
bounded-knapsack subset-sum that comes as near the target from below as the remaining documents allow.  If that does not
meet the target, as with few long documents, the fill is undone for four times as many words, again and again, until
the target is met, the knapsack has the whole budget (then nothing comes nearer) or ``DP_MOST`` words (in units of the
lengths' common divisor).  Which documents of a length are taken is decided by a seeded hash of ``doc_id``: those up to
the hash of the last one needed.

Scale: texts are read once to measure them and never shuffled.  The only rows that meet in one task are the per-source
figures (one row a source) and one source's counts by length (one row a distinct length).  Ranks are taken inside hash
ranges of about ``RANGE`` rows, so a length that a third of all rows share is not sorted in one task.

Defined results: a null text has size 0.  A source of size 0 has target 0.  Rows of one source and length that repeat
a ``doc_id`` (null included) are taken or left together.  An empty table gives an empty result.  Reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.common import bounded, n_words, staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20240229
DP_BUDGET = 1 << 16
DP_MOST = 1 << 24
RANGE = 4096
PLAN_ROWS = 200_000


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; one row a source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    shared = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most))) \
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share))) \
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                    / F.sum("weight").over(after)) \
        .withColumn("full", F.col("level") * F.col("weight") >= F.col("limit"))
    # sources in this order fill up one after the other; the first that does not sets the level of all that follow
    rest = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), "source", "level"))).over(everything)
    return shared.withColumn("rest", rest["level"]).select(
        "source", "source_size",
        F.when(F.col("full") | F.col("rest").isNull(), F.col("limit"))
        .otherwise(F.least(F.col("rest") * F.col("weight"), F.col("limit"))).alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_budget: int = DP_BUDGET) -> np.ndarray:
    """How many items of each length (distinct, positive) to take so that their sum comes nearest ``budget`` from below."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    unit = int(np.gcd.reduce(lengths))
    lengths, budget, best = lengths // unit, budget // unit, None
    while True:
        found = _fit_window(lengths, counts, budget, dp_budget)
        if best is None or (found * lengths).sum() > (best * lengths).sum():
            best = found
        if dp_budget >= min(budget, DP_MOST) or int((best * lengths).sum()) == budget:
            return best
        dp_budget = min(4 * max(1, dp_budget), DP_MOST)


def _fit_window(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_budget: int) -> np.ndarray:
    """``fit_budget`` with a knapsack over the last ``dp_budget`` words and a proportional and greedy fill before."""
    total = int((lengths * counts).sum())
    taken = np.array([c * max(0, budget - dp_budget) // total for c in counts.tolist()], np.int64)
    left = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths, kind="stable").tolist():
        if left <= dp_budget:
            break
        size = int(lengths[i])
        n = min(int(counts[i] - taken[i]), left // size, -(-(left - dp_budget) // size))
        taken[i] += n
        left -= n * size
    return taken + _subset_sum(lengths, counts - taken, left)


def _subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack by doubling parcels of each length; exact unless ``budget`` is beyond all items."""
    out = np.zeros(len(lengths), np.int64)
    usable = np.flatnonzero((lengths <= budget) & (counts > 0))
    if not len(usable) or budget <= 0:
        return out
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    first = np.full(budget + 1, -1, np.int32)
    parcels: list[tuple[int, int]] = []
    for i in usable[np.argsort(-lengths[usable], kind="stable")].tolist():
        left, n = min(int(counts[i]), budget // int(lengths[i])), 1
        while left and not reached[budget]:
            n = min(n, left)
            words = n * int(lengths[i])
            fresh = np.flatnonzero(reached[:-words] & ~reached[words:]) + words if words <= budget else ()
            first[fresh] = len(parcels)
            reached[fresh] = True
            parcels.append((i, n))
            left -= n
            n *= 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = parcels[first[at]]
        out[i] += n
        at -= n * int(lengths[i])
    return out


def _plan_source(rows: pd.DataFrame, dp_budget: int) -> pd.DataFrame:
    sizes, counts = rows["size"].to_numpy(np.int64), rows["n_docs"].to_numpy(np.int64)
    total, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    rounds = int(target // total) if total else 0
    extra = np.zeros(len(rows), np.int64)
    some = sizes > 0
    if total:
        extra[some] = fit_budget(sizes[some], counts[some], int(target - rounds * total), dp_budget)
    return pd.DataFrame({"source": rows["source"], "size": sizes, "n_docs": counts, "rounds": rounds, "extra": extra,
                         "source_size": total, "target": target})


def _draw(seed: int) -> Column:
    """A seeded uniform draw of 53 bits for each ``doc_id``."""
    return F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), 11)


def _same(source: str, size: str) -> Column:
    return F.col(source).eqNullSafe(F.col("p_source")) & (F.col(size) == F.col("p_size"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
         dp_budget: int = DP_BUDGET) -> tuple[DataFrame, DataFrame]:
    """The staged slim rows ``doc_id, source, size, draw`` and the staged plan, a row for each source and size.

    The plan (``p_source, p_size, source_size, target, rounds, last_draw, last_id``) has the whole copies of every
    document and the draw and id of the last document that is taken once more (a null draw if none is).
    """
    slim = staged(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                              n_words(F.col("text")).alias("size"), _draw(seed).alias("draw")), "mix_sizes")
    counts = slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n_docs"))
    shares = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    budget = counts.join(shares.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def per_source(rows: pd.DataFrame) -> pd.DataFrame:
        return _plan_source(rows, dp_budget)

    fitted = staged(budget.groupBy("source").applyInPandas(
        per_source, "source string, size long, n_docs long, rounds long, extra long, source_size long, target double")
        .withColumnsRenamed({"source": "p_source", "size": "p_size"}), "mix_plan")

    # the document of rank ``extra`` by draw: its range of draws by the ranges' counts, then its rank in that range
    key = ["p_source", "p_size"]
    some = fitted.where("extra > 0 and extra < n_docs").select(
        *key, "extra", F.ceil(F.col("n_docs") / F.lit(RANGE)).alias("ranges"))
    dealt = slim.join(some, _same("source", "size")).withColumn(
        "part", F.floor(F.col("draw") / F.lit(float(1 << 53)) * F.col("ranges")))
    upto = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = dealt.groupBy(*key, "extra", "part").count().withColumn("upto", F.sum("count").over(upto)) \
        .where("upto >= extra and upto - count < extra") \
        .select(*key, "part", (F.col("extra") - F.col("upto") + F.col("count")).alias("need"))
    inside = dealt.alias("d").join(
        found.alias("f"), F.expr("d.p_source <=> f.p_source and d.p_size = f.p_size and d.part = f.part")) \
        .select(*[f"d.{x}" for x in key], "draw", "doc_id", "need")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("draw", "doc_id"))
    last = inside.withColumn("rank", rank).where("rank = need") \
        .select(*key, F.col("draw").alias("draw_of_last"), F.col("doc_id").alias("last_id"))
    everyone = F.when(F.col("extra") == F.col("n_docs"), F.lit(1 << 53))
    by_length = fitted.alias("p").join(
        last.alias("l"), F.expr("p.p_source <=> l.p_source and p.p_size = l.p_size"), "left") \
        .select(*[f"p.{x}" for x in key], "source_size", "target", "rounds",
                F.coalesce(everyone, F.col("draw_of_last")).alias("last_draw"), "last_id")
    return slim, staged(by_length, "mix_thresholds")


def _copies(doc_id: str, draw: str) -> Column:
    """How often a document joined with its row of the plan is taken."""
    tie = F.col(doc_id).isNull() | (F.col(doc_id) <= F.col("last_id"))
    more = (F.col(draw) < F.col("last_draw")) | ((F.col(draw) == F.col("last_draw")) & tie)
    return F.col("rounds") + F.coalesce(more, F.lit(False)).cast("long")


def verdicts(docs: DataFrame, **how) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    slim, by_length = plan(docs, **how)
    return slim.join(bounded(by_length, PLAN_ROWS), _same("source", "size")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies("doc_id", "draw")).alias("taken"))


def mix(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """``docs`` in the mix: a document appears as often as it is taken, with its columns and nothing else."""
    _, by_length = plan(docs, seed=seed, **how)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col("doc_id"), F.col("source").cast("string").alias("source"),
                       n_words(F.col("text")).alias("size"), _draw(seed).alias("draw"))
    taken = rows.join(bounded(by_length, PLAN_ROWS), _same("source", "size")) \
        .select("doc", _copies("doc_id", "draw").alias("copies")).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
