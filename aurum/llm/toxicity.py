"""Toxicity by a weighted lexicon that an Aho-Corasick automaton matches in folded text.

Folding lower-cases, maps look-alike letters of other scripts and full-width forms to Latin ones, undoes digit and
sign substitutions inside words, and turns everything else that is no letter into a space.  The lexicon is learned
from labelled rows: word beginnings and whole words whose document frequency among toxic rows is far above that among
clean rows, with the log odds as weight.  Exception phrases, pairs of neighbouring words around a hit that clean rows
have and toxic rows have not (or that the caller gives), cancel the weight of the hit inside them.  The score is a
logistic function of the summed weight, plain and per word.

The fit reads at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` clean labelled rows (those of smallest
``xxhash64(doc_id)``) and keeps at most ``LEXICON`` entries and ``EXCEPTIONS`` phrases, so that the model has a bounded
size and travels with the tasks.  Scoring reads every whole text once, with no shuffle.

Defined results: a null or empty text has no hits and gets the score of such texts.  Labels that are null or neither
0 nor 1 are ignored; a row labelled twice counts as toxic if one label says so.  Without labelled rows of both kinds
the lexicon is empty and every score is 0.  Repeated rows are each scored.  Other columns are never inputs.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import staged

TOXIC_ROWS = 4_000
CLEAN_ROWS = 12_000
LEXICON = 5_000
EXCEPTIONS = 1_000
#: An entry occurs in at least so many toxic rows of the sample, and in one of a hundred.
MIN_ROWS = 8
MIN_LOG_ODDS = 3.0
STEM = range(4, 9)
THRESHOLD = 0.3

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
LOOK_ALIKES = dict(zip("авеёзіјкмнорсԁтухѕԛԝαβεηικνορτυχγ", "abeeзijkmhopcdtyxsqwabeniknoptuxy", strict=True))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}


class _Letters(dict):
    """Translation of one lower-case character, worked out when it is first met."""

    def __missing__(self, code: int) -> str:
        char = unicodedata.normalize("NFKC", chr(code)).lower()
        char = "".join(LOOK_ALIKES.get(c, c) for c in char)
        keep = all(c.isalnum() or c in "@$" for c in char)
        self[code] = char if keep and char else " "
        return self[code]


_LETTERS = _Letters()
_DIGIT = str.maketrans(SUBSTITUTES)
_HAS_DIGIT = re.compile(r"[0-9@$]")


def _undo(word: str) -> str:
    """Digits and signs of a word become letters if a letter is beside them; a pure number stays out."""
    return word.translate(_DIGIT) if any(c.isalpha() for c in word) else ""


def fold(text: str | None) -> str:
    """The folded words of a text, each with a space around it."""
    if not text:
        return " "
    plain = text.lower().translate(_LETTERS)
    if _HAS_DIGIT.search(plain):
        plain = " ".join([_undo(w) if _HAS_DIGIT.search(w) else w for w in plain.split()])
    return f" {plain} "


@dataclass
class Model:
    """Patterns of folded text with their weights, and the logistic function of the summed weight."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, float, float] | None = None

    def __post_init__(self) -> None:
        self._automaton = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_automaton": None}

    def _matcher(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for pattern, weight in (*self.weights.items(), *self.exceptions.items()):
                self._automaton.add_word(pattern, self._automaton.get(pattern, 0.0) + weight)
            self._automaton.make_automaton()
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, float]]:
        return list(self._matcher().iter(folded)) if self.weights else []

    def total(self, text: str | None) -> tuple[float, int]:
        """Summed weight of a text's hits without those that exceptions cancel, and its number of words."""
        folded = fold(text)
        if not self.weights:
            return 0.0, 0
        total = sum([w for _, w in self._matcher().iter(folded)])
        return (max(0.0, total), len(folded.split())) if total > 1e-9 else (0.0, 0)

    def score(self, text: str | None) -> float:
        if self.coefficients is None:
            return 0.0
        total, words = self.total(text)
        bias, plain, dense = self.coefficients
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + plain * math.log1p(total) + dense * _per_word(total, words)))))


def _per_word(total: float, words: int) -> float:
    return min(1.0, total / words) if words else 0.0


def _features(folded: str) -> set[str]:
    """Word beginnings (``" abcd"``) and whole words (``" abcdef "``) of a folded text."""
    out = set()
    for word in set(folded.split()):
        if len(word) >= STEM.start:
            out.add(f" {word} ")
            out.update([f" {word[:n]}" for n in STEM if n <= len(word)])
        elif len(word) > 2:
            out.add(f" {word} ")
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """The distinct texts of the bounded sample of labelled rows: ``text, toxic``; ``learn`` says of a ``doc_id`` if it may be used."""
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")) \
        .where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = marked.where("toxic = 1").orderBy(order, "doc_id").limit(TOXIC_ROWS) \
        .unionByName(marked.where("toxic = 0").orderBy(order, "doc_id").limit(CLEAN_ROWS))
    return staged(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
                  .dropDuplicates(["text", "toxic"]), "toxicity_sample")


def _counted(rows: DataFrame, keep: set[str] | None, at_least: int) -> dict[str, int]:
    """Document frequency of features, pre-aggregated in each task; only those of ``keep`` or of ``at_least`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = _features(fold(text))
                found.update(own if keep is None else own & keep)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(list(found), pa.string()),
                                          "n": pa.array(list(found.values()), pa.int64())})

    summed = rows.select("text").mapInArrow(count, "feature string, n long").groupBy("feature") \
        .agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)
    return {r["feature"]: r["n"] for r in summed.collect()}


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """The lexicon: strong features, the most specific of those that say the same, without those a shorter one covers."""
    odds = {f: math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean.get(f, 0) + 0.5) / (n_clean + 1))
            for f, n in toxic.items()}
    strong = {f for f, x in odds.items() if x >= MIN_LOG_ODDS}
    kept: set[str] = set()
    for f in sorted(strong, key=lambda f: (len(f.rstrip()), f.endswith(" "), f)):
        shorter = [f[:n] for n in range(STEM.start + 1, len(f.rstrip()) + f.endswith(" ")) if f[:n] in kept]
        same = [s for s in shorter if toxic[f] >= 0.9 * toxic[s] and odds[f] >= odds[s] - 0.1]
        if len(same) == len(shorter):
            kept.difference_update(same)
            kept.add(f)
    best = sorted(kept, key=lambda f: (-odds[f] * toxic[f], f))[:LEXICON]
    return {f: round(odds[f], 6) for f in best}


def _neighbours(rows: DataFrame, model: Model) -> dict[tuple[str, int], int]:
    """Rows that hold a pair of words of which one is a hit, by the pair and the label; pre-aggregated in each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = fold(text)
                if model.hits(folded):
                    words = folded.split()
                    hit = [bool(model.hits(f" {w} ")) for w in words]
                    found.update({(f" {a} {b} ", toxic) for a, b, x, y in zip(words, words[1:], hit, hit[1:], strict=False)
                                  if x != y})
        keys = list(found)
        yield pa.RecordBatch.from_pydict({
            "phrase": pa.array([k for k, _ in keys], pa.string()), "toxic": pa.array([t for _, t in keys], pa.int32()),
            "n": pa.array([found[k] for k in keys], pa.int64())})

    pairs = rows.mapInArrow(count, "phrase string, toxic int, n long").groupBy("phrase").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n"))).alias("clean"),
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("marked"))
    kept = pairs.where("clean >= 3 and marked * 10 <= clean").orderBy(F.desc("clean"), "phrase").limit(EXCEPTIONS)
    return {r["phrase"]: r["clean"] for r in kept.collect()}


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> tuple[float, float, float]:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, exceptions: Iterable[str] = ()) -> Model:
    """A model from the labelled rows of ``docs`` for which ``learn`` holds (by default: not held out)."""
    rows = training_rows(docs, labels, ~held_out(F.col("doc_id")) if learn is None else learn)
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return Model()
    toxic = _counted(rows.where("toxic = 1"), None, max(MIN_ROWS, n[1] // 100))
    clean = _counted(rows.where("toxic = 0"), set(toxic), 1)
    model = Model(choose(toxic, clean, n[1], n[0]))
    if not model.weights:
        return model
    phrases = [*_neighbours(rows, model), *(fold(p) for p in exceptions)]
    model = Model(model.weights, {p: -sum(w for _, w in model.hits(p)) for p in phrases if model.hits(p)})

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.total(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "total": pa.array([t for t, _ in found], pa.float64()),
                "words": pa.array([w for _, w in found], pa.int64()), "toxic": batch.column(1)})

    seen = rows.mapInArrow(totals, "total double, words long, toxic int").collect()  # the bounded sample
    x = np.array([[1.0, math.log1p(r["total"]), _per_word(r["total"], r["words"])] for r in seen])
    model.coefficients = _logistic(x, np.array([r["toxic"] for r in seen], float))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def verdicts(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    return scored(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the model finds toxic; its columns and nothing else."""
    model, schema = fit(docs, labels), docs.schema
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [model.score(t.as_py()) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, schema)
