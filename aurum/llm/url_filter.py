"""URL filters: longest-match host and path rules, and for the rest naive Bayes over Viterbi-segmented names.

The letter runs of host and path are split into words by a unigram Viterbi search (``cheappills`` into ``cheap``,
``pills``) whose word counts come from the html of all pages.  Pages whose host has one of the ``SEEDS`` among its
words are the block class of a multinomial naive Bayes, all others the allow class; word probabilities are smoothed
towards those of all words, so a word that only one class has counts for that class however rare it is.  A url is
blocked if its log odds, summed as whole millionths, are above zero.

Scale: everything after the word count works on distinct pairs of host and path shape (digits folded), with their
numbers of pages, so a host that a third of all pages share is one row.  Only words that occur inside a name are kept
of the word counts, found by joins; a name is segmented with the counts of its own substrings, so no vocabulary is
cut off or broadcast.  Verdicts return to the pages by a join whose small side is broadcast while its counted rows
are few.

Defined results: a null url or one without ``://`` has empty host and path, which no rule fits, and is judged by the
prior alone.  Null html has no words.  Repeated rows each get a row.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import bounded, staged

ALLOW, BLOCK = "allow", "block"
# Words of gambling, drug, adult, spam and advertising hosts.
SEEDS = ("adserver", "ads", "adult", "bet", "bets", "betting", "casino", "cialis", "escort", "gambling", "jackpot",
         "malware", "payday", "phishing", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "torrent",
         "tracker", "viagra", "warez", "xxx")
LONGEST_WORD = 20
SEED_COUNT = 1_000
#: Weight of all words' frequencies in those of a class, in words.
SMOOTHING = 50
_UNIT = 1e6


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id, host, path`` of every page."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    parts = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.regexp_extract("rest", "^[^/?#]*", 0)
    return parts.select("page_id", _ascii_lower(host).alias("host"),
                        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"))


def ruled(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (``host/path``, else null) and its verdict; ``rules`` are ``(verdict, host/path)``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = text.partition("/")
        at_host = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits = at_host & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def word_counts(html: DataFrame) -> DataFrame:
    """``word, n``: letter runs of at most ``LONGEST_WORD`` letters in the column ``html``, lower-cased."""
    words = html.select(F.explode(F.split(F.lower("html"), "[^a-z]+")).alias("word"))
    return words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of a name; an unknown word of length L has probability 10 / (total * 10**L)."""
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]  # log probability, minus the number of words, start of the last
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - LONGEST_WORD), end):
            word = name[start:end]
            n = counts.get(word)
            p = math.log(n / total) if n else math.log(10 / total) - len(word) * math.log(10)
            options.append((round(best[start][0] + p, 9), best[start][1] - 1, start))
        best.append(max(options))
    words, end = [], len(name)
    while end:
        start = best[end][2]
        words.append(name[start:end])
        end = start
    return words[::-1]


def segmented(names: DataFrame, counts: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """``name, words`` for distinct letter runs ``name``, by the counts of their own substrings; staged."""
    starts = F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start")
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("start") + 1)))
    inside = names.select("name", starts).select("name", "start", lengths.alias("n_letters")) \
        .select("name", F.expr("substring(name, start, n_letters)").alias("word")).distinct()
    total = max(1, counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    own = inside.join(counts, "word").groupBy("name").agg(
        F.collect_list("word").alias("known"), F.collect_list("n").alias("n"))
    least = max(SEED_COUNT, total // 10_000)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for name, known, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                have = dict(zip(known or (), n or (), strict=True))
                have.update({s: max(least, have.get(s, 0)) for s in seeds if s in name})
                words.append(viterbi(name, have, total))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))],
                                             names=["name", "words"])

    return staged(names.join(own, "name", "left").select("name", "known", "n")
                  .mapInArrow(split, "name string, words array<string>"), "url_names")


def judged(pairs: DataFrame, names: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """``host, shape, log_odds`` (millionths; above 0 for block) of distinct pairs that have ``n`` pages each."""
    def runs(place: str) -> DataFrame:
        found = F.regexp_extract_all(F.lower(place), F.lit("([a-z]+|[0-9]+)"), 1)
        return pairs.select("host", "shape", "n", F.lit(place == "host").alias("in_host"), F.explode(found).alias("name"))

    parts = runs("host").unionByName(runs("shape"))
    tokens = staged(parts.join(bounded(names), "name", "left").select(
        "host", "shape", "n", "in_host", F.explode(F.coalesce("words", F.array("name"))).alias("word")), "url_tokens")
    seeded = tokens.where(F.col("in_host") & F.col("word").isin(*seeds)).select("host").distinct() \
        .withColumn("block", F.lit(True))
    labels = pairs.select("host").distinct().join(seeded, "host", "left") \
        .select("host", F.coalesce("block", F.lit(False)).alias("block"))
    labels = staged(labels, "url_labels")
    known = tokens.join(bounded(labels), "host")
    by_word = staged(known.groupBy("word").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("block"), F.col("n"))), F.lit(0)).alias("blocked")),
        "url_words")
    sums = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    total, blocked = max(1, sums[0]), sums[1]
    pages = pairs.join(bounded(labels), "host").agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("block"), F.col("n"))), F.lit(0))).first()
    prior = round(_UNIT * math.log((pages[1] + 0.5) / (pages[0] - pages[1] + 0.5)))
    background = F.lit(float(SMOOTHING)) * F.col("n") / F.lit(float(total))

    def chance(n: Column, size: int) -> Column:
        return (n + background) / F.lit(float(size + SMOOTHING))

    odds = F.log(chance(F.col("blocked"), blocked)) - F.log(chance(F.col("n") - F.col("blocked"), total - blocked))
    model = staged(by_word.select("word", F.round(odds * F.lit(_UNIT)).cast("long").alias("odds")), "url_model")
    scores = tokens.join(bounded(model), "word").groupBy("host", "shape").agg(F.sum("odds").alias("odds"))
    return staged(pairs.join(scores, ["host", "shape"], "left").select(
        "host", "shape", (F.coalesce("odds", F.lit(0)) + F.lit(prior)).alias("log_odds")), "url_pairs")


def verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]], seeds: Sequence[str] = SEEDS) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict`` and ``log_odds`` of the method, in millionths."""
    shape = F.regexp_replace("path", "[0-9]+", "0")
    urls = staged(with_host_and_path(pages).withColumn("shape", shape), "urls")
    pairs = staged(urls.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n")), "url_pair_counts")
    runs = F.regexp_extract_all(F.lower(F.concat_ws(" ", "host", "shape")), F.lit("([a-z]+)"), 1)
    names = staged(pairs.select(F.explode(runs).alias("name")).distinct(), "url_runs")
    log_odds = judged(pairs, segmented(names, staged(word_counts(pages.select("html")), "url_counts"), seeds), seeds)
    rule, verdict = ruled(rules)
    own = F.when(F.col("log_odds") > 0, BLOCK).otherwise(ALLOW)
    return urls.join(bounded(log_odds), ["host", "shape"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "log_odds")
