"""The registered queries against their SQL, and the pipeline against a plain version on the smallest tables."""

import re
import zlib
from collections import Counter

import corpus_pipeline
import pytest

from aurum.llm import toxicity
from aurum.llm.queries import QUERIES, SQL
from tests.llm.test_dedup_and_join import brute_components
from tests.llm.test_mix_score_and_pack import n_words, plain_targets
from tools.compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    found = compare(spark, SF, [name], verbose=False)[name]
    assert "error" not in found and found["cols_ok"] and found["types_ok"] and found["values_ok"], found


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_is_that_of_a_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    left = [r for r in rows if model.score(r.text) < 0.3]
    best = {}
    for r in left:
        best[r.text or ""] = max(r.doc_id, best.get(r.text or "", r.doc_id))
    left = [r for r in left if best[r.text or ""] == r.doc_id]
    roots = brute_components([(r.doc_id, r.text) for r in left])
    left = {r.doc_id: r for r in left if roots[r.doc_id][1] == r.doc_id}
    sizes = Counter()
    for r in left.values():
        sizes[r.source] += n_words(r.text)
    pieces = corpus_pipeline.run(spark, SF).collect()
    copies = Counter(r.doc_id for r in pieces if r.piece == 0)
    assert set(copies) <= set(left) and max(copies.values()) <= 2
    taken = Counter()
    for i, n in copies.items():
        taken[left[i].source] += n * n_words(left[i].text)
    for s, target in plain_targets(sizes).items():
        rounds = int(target // sizes[s])
        budget = int(target - rounds * sizes[s])
        sums = 1                                             # bit n: n words can be taken once more
        for r in left.values():
            if r.source == s:
                sums |= sums << n_words(r.text)
        best = (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1
        assert taken[s] == rounds * sizes[s] + best, (s, target, taken[s])
    fill = Counter()
    for r in pieces:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    assert len(fill) <= -(-sum(fill.values()) // 2048) + 2
    ids = Counter((r.doc_id, r.piece, r.ids_crc32) for r in pieces)
    assert all(n == copies[i] for (i, _, _), n in ids.items())


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_join", "source_mix", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        if stage is not corpus_pipeline.drop_near_copies:
            assert stage(spark, docs, SF).columns == docs.columns
    assert zlib.crc32(b"1") % 4 in range(4)
