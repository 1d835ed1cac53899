import hashlib
from collections import Counter

import pytest

from aurum.llm import exact_dedup, ngram_join
from aurum.llm.components import components
from tests.llm.helpers import documents, noisy, words
from tests.llm.test_text_tools import plain_shingles

EDGES = [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "one two"), (905, "One TWO"),
         (906, "w " * 30_000), (906, "w " * 30_000), (None, "no id at all")]


def want_verdicts(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, *_ in rows:
        same = groups[t or ""]
        keep = max((x for x in same if x is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_exact_dedup(spark, broadcast_rows):
    rows = [(i, f"text {i % 90} é") for i in range(250)] + [(i, "hot") for i in range(1000, 1200)] + EDGES
    df = documents(spark, rows, extra=True).repartition(5)
    got = exact_dedup.verdicts(df, broadcast_rows).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want_verdicts(rows)
    kept = exact_dedup.deduplicate(df, broadcast_rows)
    assert kept.columns == df.columns
    best = {}
    for i, t, *_ in rows:
        if i is not None or (t or "") not in best:
            best[t or ""] = max((x for x in (i, best.get(t or "")) if x is not None), default=None)
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter((i, t) for t, i in best.items())


def test_exact_dedup_of_nothing(spark):
    df = documents(spark, [])
    assert exact_dedup.verdicts(df).count() == 0 and exact_dedup.deduplicate(df).count() == 0


def brute_components(rows):
    sets = {i: plain_shingles(t) for i, t, *_ in rows if i is not None}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus():
    passage = words(50, 99, 10**6)
    rows = []
    for c in range(6):                                       # clusters of near copies around the threshold
        base = words(80, c, 10**6)
        rows += [(100 * c + k, " ".join(noisy(base, 1 + k % 4, 1000 * c + k))) for k in range(1, 14)]
    rows += [(2000 + k, " ".join(words(20 + 3 * k, 50 + k, 10**6) + passage)) for k in range(30)]
    rows += [(3000 + k, " ".join(passage + words(k % 12, 500 + k, 10**6))) for k in range(25)]
    return rows + [(4000 + k, rows[5][1]) for k in range(8)]


@pytest.mark.parametrize("node, heavy_keys", [(64, 18), (4, 96)])
def test_ngram_join_is_that_of_all_pairs(spark, monkeypatch, node, heavy_keys):
    """With small nodes nearly every shared key is a frequent one."""
    monkeypatch.setattr(ngram_join, "NODE", node)
    monkeypatch.setattr(ngram_join, "HEAVY_KEYS", heavy_keys)
    monkeypatch.setattr(ngram_join, "HEAVY_NODE", node)
    monkeypatch.setattr(ngram_join, "MEETING_NODE", 2 * node)
    rows = corpus() + EDGES
    df = documents(spark, rows, extra=True).repartition(4)
    got = ngram_join.linked_components(df).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    if node == 64:
        kept = ngram_join.deduplicate(df)
        assert kept.columns == df.columns
        assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()} | {None}


def test_rows_that_share_an_id_are_one_document(spark):
    a, b = " ".join(words(40, 1, 10**6)), " ".join(words(40, 2, 10**6))
    rows = [(5, a), (3, a), (5, b), (4, b), (9, "alone and not linked with any")]
    got = {(r.doc_id, r.component_id) for r in ngram_join.linked_components(documents(spark, rows)).collect()}
    assert got == {(5, 3), (3, 3), (4, 3), (9, 9)}


def test_ngram_join_of_nothing(spark):
    assert ngram_join.linked_components(documents(spark, [])).count() == 0
    only = documents(spark, [(1, None), (2, "  ")])
    assert {tuple(r) for r in ngram_join.linked_components(only).collect()} == {(1, 0, 1), (2, 0, 2)}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(20)] + [(300, 299), (299, 298)]
    df = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(20)}, 298: 298, 299: 298, 300: 298}
    assert components(df.limit(0)).count() == 0


def test_a_filter_too_large_to_broadcast_shuffles_no_text(spark):
    from pyspark.sql import functions as F
    docs = documents(spark, [(i, f"text {i % 300}") for i in range(900)])
    body = F.coalesce(F.col("text"), F.lit(""))
    bloom = exact_dedup.fit(docs, body, broadcast_rows=0)
    hashed = docs.select("doc_id", F.xxhash64(body).alias("hash"), F.sha2(body, 256).alias("text_sha256"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bloom.test(hashed, F.col("hash"), "maybe")._jdf.queryExecution().executedPlan().toString()
        got = exact_dedup.verdicts(docs, broadcast_rows=0).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" in plan
    shuffled = plan[plan.index("Exchange hashpartitioning"):].split("\n")[1]   # the projection below the exchange
    assert "sha2(" in shuffled                               # the text ends there
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, 600 + i % 300, 3) for i in range(900)}
