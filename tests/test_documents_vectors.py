import numpy as np
from pyspark.sql import functions as F

from aurum.operators import documents as D
from aurum.operators import merge as M
from aurum.operators import vectors as V


def test_document_upsert_semantics(spark):
    base = D.from_json_object(spark.createDataFrame([
        ("ESC-1", '{"nome": "A", "infra": {"agua": true, "luz": true}, "turmas": 4, "obs": "x"}')],
        "id string, doc string"), "id", "doc")
    new = D.from_json_object(spark.createDataFrame([
        ("ESC-1", '{"infra": {"agua": false}, "turmas": null}'), ("ESC-2", '{"nome": "B"}')],
        "id string, doc string"), "id", "doc")
    out = {r.id: r.body for r in D.upsert_documents(base, new, "id").collect()}
    one = out["ESC-1"]
    assert one["nome"] == '"A"' and one["obs"] == '"x"'                # untouched fields stay
    assert one["infra"] == '{"agua":false}'                        # nested object replaced whole
    assert one["turmas"] == "null"                                 # explicit null kept (vs absent)
    assert out["ESC-2"] == {"nome": '"B"'}


def test_both_encodings_of_a_body_are_the_same(spark):
    row = spark.createDataFrame([(1, "007", 5, None)], "k bigint, s string, n int, v double")
    text = spark.createDataFrame([(1, '{"s": "007", "n": 5}')], "k bigint, doc string")
    bodies = [D.to_documents(row, "k"), D.from_json_object(text, "k", "doc")]
    assert [b.first().body for b in bodies] == [{"s": '"007"', "n": "5"}] * 2
    for b in bodies:
        r = b.select(D.field("body", "s").alias("s"), D.field("body", "n", "int").alias("n"),
                     F.variant_get(D.as_variant("body", "s"), "$", "string").alias("v")).first()
        assert tuple(r) == ("007", 5, "007")


def test_vector_table_is_created_inserted_into_and_read_back(spark, scratch):
    rows = [(1, "a", [1.0, 0.0]), (2, "b", [0.0, 1.0]), (3, "a", [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, title string, embedding array<float>")
    stored = V.create_table(df.where("vec_id = 1"), f"{scratch}/v", 2)
    assert stored.count() == 1
    assert V.insert_if_absent_into(f"{scratch}/v", df, ["title", "embedding"], 2) == 1   # 3 breaks the contract
    assert V.insert_if_absent_into(f"{scratch}/v", df, ["title", "embedding"], 2) == 0
    assert sorted(r.vec_id for r in spark.read.parquet(f"{scratch}/v").collect()) == [1, 2]


def test_to_documents_and_field_access(spark):
    df = spark.createDataFrame([(1, 5, "click", None)], "k bigint, n int, t string, v double")
    docs = D.to_documents(df, "k")
    r = docs.select(D.field("body", "n", "int").alias("n"),
                    F.get_json_object(F.col("body")["t"], "$").alias("t"), F.size("body").alias("s")).first()
    assert (r.n, r.t, r.s) == (5, "click", 2)


def test_insert_if_absent_twice_adds_nothing(spark):
    """re-inserting the same rows is a no-op on the content key."""
    rows = [("2312908", "Plano A", [0.92, 0.15, 0.35, 0.40]), ("3550308", "Plano B", [0.78, 0.25, 0.40, 0.30])]
    incoming = spark.createDataFrame(rows, "id_municipio string, titulo string, embedding array<float>")
    table = incoming.limit(0)
    for _ in range(2):
        table = M.append_if_absent(table, incoming, ["id_municipio", "titulo"])
    assert table.count() == 2
    checked = V.with_dimension_check(table, "embedding", 4)
    assert checked.where("_dims_ok").count() == 2


def _brute(base, queries, k, metric):
    out = []
    for qid, q in queries:
        scores = []
        for vid, v in base:
            if metric == "dot":
                s = float(np.dot(q, v))
            elif metric == "cosine":
                s = float(np.dot(q, v) / (np.linalg.norm(q) * np.linalg.norm(v)))
            else:
                s = float(np.linalg.norm(np.array(q) - np.array(v)))
            scores.append((s, vid))
        scores.sort(key=lambda t: (t[0] if metric == "l2" else -t[0], t[1]))
        out += [(qid, vid, r + 1) for r, (_, vid) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_matches_brute_force_for_every_metric_and_block_size(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = [(i, rng.normal(size=8).round(3).tolist()) for i in range(200)]
    queries = [(1000 + j, rng.normal(size=8).round(3).tolist()) for j in range(7)]
    bdf = spark.createDataFrame(base, "vec_id bigint, embedding array<double>").repartition(4)
    qdf = spark.createDataFrame(queries, "qid bigint, qvec array<double>")
    for metric in V.METRICS:
        want = _brute(base, queries, 5, metric)
        for rows, asked in ((V.BASE_BLOCK, V.QUERY_BLOCK), (16, 2)):
            monkeypatch.setattr(V, "BASE_BLOCK", rows)
            monkeypatch.setattr(V, "QUERY_BLOCK", asked)
            got = sorted((r.qid, r.vec_id, r.rank) for r in V.top_k(bdf, qdf, k=5, metric=metric).collect())
            assert got == want, (metric, rows, asked)


def test_top_k_keeps_exact_ties_and_excludes_self(spark):
    # four identical vectors tie exactly: the smaller ids must win, whatever batch they are in
    base = [(i, [1.0, 0.0]) for i in (9, 3, 7, 5)] + [(1, [0.0, 1.0]), (2, [0.5, 0.5])]
    bdf = spark.createDataFrame(base, "vec_id bigint, embedding array<double>").repartition(3)
    q = spark.createDataFrame([(3, [1.0, 0.0])], "qid bigint, qvec array<double>")
    got = [r.vec_id for r in V.top_k(bdf, q, k=3, exclude_self=True).orderBy("rank").collect()]
    assert got == [5, 7, 9]


def test_filtered_retrieval(spark):
    base = spark.createDataFrame([(1, [1.0, 0.0], True), (2, [0.9, 0.1], False), (3, [0.5, 0.5], True)],
                                 "vec_id bigint, embedding array<double>, passed boolean")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "qid bigint, qvec array<double>")
    got = [r.vec_id for r in V.top_k(base, q, k=2, filter_expr=F.col("passed")).orderBy("rank").collect()]
    assert got == [1, 3]


def test_feature_table_clusters_and_risk(spark):
    from aurum.operators import gold as G
    from aurum.operators import ml as ML
    rng = np.random.default_rng(3)
    rows = [(f"{i:07d}", "SP", 2023, float(s), float(r), float(t))
            for i, (s, r, t) in enumerate(zip(rng.uniform(600, 900, 60), rng.uniform(40, 100, 60),
                                              rng.uniform(50, 90, 60)))]
    silver = spark.createDataFrame(rows, "id_municipio string, sigla_uf string, ano int, "
                                         "media_proficiencia_saeb double, indicador_alfabetizacao double, "
                                         "meta_alfabetizacao double")
    feats = ML.feature_table(G.fact_indicator(silver), G.fact_target(silver))
    clusters = ML.fit_clusters(feats, k=3)
    assert clusters.count() == 60 and clusters.select("cluster").distinct().count() == 3
    risk = ML.fit_risk(feats)
    assert {"prediction", "probability"} <= set(risk.columns) and risk.count() == 60


def test_top_k_skips_vectors_that_break_the_contract(spark):
    base = [(1, [1.0, 0.0]), (2, None), (3, [1.0, 0.0, 5.0]), (4, [float("nan"), 1.0]), (5, [0.5, 0.5])]
    bdf = spark.createDataFrame(base, "vec_id bigint, embedding array<double>")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "qid bigint, qvec array<double>")
    got = [r.vec_id for r in V.top_k(bdf, q, k=5).orderBy("rank").collect()]
    assert got == [1, 5]


def test_variant_path_access(spark):
    base = D.from_json_object(spark.createDataFrame(
        [("ESC-1", '{"infra": {"agua": true, "mbps": 100}, "recursos": ["Biblioteca", "Sala"]}')],
        "id string, doc string"), "id", "doc")
    r = base.select(F.variant_get(D.as_variant("body", "infra"), "$.mbps", "int").alias("mbps"),
                    F.variant_get(D.as_variant("body", "recursos"), "$[1]", "string").alias("r1")).first()
    assert (r.mbps, r.r1) == (100, "Sala")


def test_exact_distances_hold_few_differences_at_a_time():
    import tracemalloc
    rng = np.random.default_rng(1)
    b, q = rng.normal(size=(V.BASE_BLOCK, 64)), rng.normal(size=(V.QUERY_BLOCK, 64))
    tracemalloc.start()
    try:
        got = V._scores("l2", b, q)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 << 20      # all differences of the two blocks and their squares take 268 MB
    assert np.array_equal(got[::100, ::50], [[np.sqrt(((x - y) ** 2).sum()) for y in q[::50]] for x in b[::100]])


def test_blocks_are_scored_as_arrow_arrays(spark):
    base = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], "vec_id bigint, embedding array<double>")
    asked = base.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    out = V.top_k(base, asked, k=2, exclude_self=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "BatchEvalPython" not in plan
    assert sorted((r.qid, r["rank"], r.vec_id) for r in out.where("qid < 2").collect()) == [(0, 1, 1), (0, 2, 2), (1, 1, 8), (1, 2, 7)]


def test_queries_without_an_id_and_vectors_without_components_are_scored(spark):
    base = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, []), (4, [])], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(None, [1.0]), (2, [1.0]), (3, [])], "qid bigint, qvec array<double>")
    got = {(r.qid, r["rank"], r.vec_id, r.score) for r in V.top_k(base, asked, k=2, exclude_self=True).collect()}
    assert got == {(None, 1, 2, 2.0), (None, 2, 1, 1.0), (2, 1, 1, 1.0), (3, 1, 4, 0.0)}
