"""Published means do not depend on the order of rows; distinct ids and models with given parameters against plain code."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from aurum.functions.rounding import exact_mean
from aurum.operators import analytics as A
from aurum.operators import ml as ML

FACT = "id_municipio string, sigla_uf string, ano int, media_proficiencia_saeb double, indicador_alfabetizacao double, atingiu_corte_alfabetizado boolean"


def half_up(values, shift=Decimal(0)):
    total = sum((Decimal(repr(v)).quantize(Decimal("1e-8"), ROUND_HALF_UP) - shift for v in values), Decimal(0))
    steps = (abs(total) * 200 + len(values)) // (2 * len(values))
    return float(steps) / 100 * (-1 if total < 0 else 1) + 0.0


def fact_rows(n=4000, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        q, d, m = rng.randrange(1, 200), rng.randrange(0, 40), rng.randrange(1, 8)
        out.append((f"{i % 900:07d}", f"g{i % 6}", 2000 + i % 4, 29 * q / m, 10 * d / m, bool(i % 3)))
    return out


def test_means_are_the_same_in_any_order(spark):
    rows = fact_rows()
    seen = set()
    for seed in range(5):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        fact = spark.createDataFrame(shuffled, FACT).repartition(1 + 3 * seed)
        seen.add((tuple(sorted(map(tuple, A.yoy_evolution(fact).collect()))),
                  tuple(sorted(map(tuple, A.state_ranking(fact).collect()))),
                  tuple(sorted(map(tuple, A.group_rank_and_mean(fact).collect())))))
    assert len(seen) == 1
    yearly, ranking, _ = seen.pop()
    for group, year, score, rate, *_ in yearly:
        own = [r for r in rows if r[1] == group and r[2] == year]
        assert score == half_up([r[3] for r in own]) and rate == half_up([r[4] for r in own])
    for row in spark.createDataFrame(rows, FACT).transform(A.state_ranking).collect():
        own = [r[3] for r in rows if r[1] == row.sigla_uf]
        assert row.gap_media_saeb == half_up(own, Decimal("743.0"))


def test_ties_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.005), ("b", -1.005), ("c", None), ("d", 0.004), ("d", 0.006), ("e", 2.675), ("e", None)], "k string, x double")
    got = dict(map(tuple, df.groupBy("k").agg(exact_mean("x").alias("m")).collect()))
    assert got == {"a": 1.01, "b": -1.01, "c": None, "d": 0.01, "e": 2.68}


def test_distinct_entities_of_any_form(spark):
    ids = ["0000007", "7", "0000007", "9999999", "10000000", "00000070", "x000007", "1" * 18, "1" * 19, None, "", "000000000000000007"]
    rows = [(i, f"g{k % 2}", 2000) for k in range(6) for i in ids] + [(None, "g9", 2000)]
    df = spark.createDataFrame(rows, "id_municipio string, sigla_uf string, ano int").repartition(4)
    got = {r.sigla_uf: r.n_entities for r in A.distinct_entities(df, ["sigla_uf"]).collect()}
    assert got == {"g0": len({i for i in ids if i is not None}), "g1": len({i for i in ids if i is not None})}
    numbers = spark.createDataFrame([(i, "g") for i in [*range(9_000_000, 9_100_000), 3]], "id_municipio long, sigla_uf string")
    assert A.distinct_entities(numbers, ["sigla_uf"]).first().n_entities == 100_001


def test_models_with_given_parameters(spark):
    rows = [("1", 2000, 30.0, 50.0, -40.0), ("2", 2000, 50.0, 50.0, 0.0), ("3", 2000, None, 50.0, 0.0), ("4", 2000, 40.0, 50.0, -20.0)]
    df = spark.createDataFrame(rows, "id_municipio string, ano int, indicador_alfabetizacao double, meta_oficial double, gap_percentual double")
    near = {r.id_municipio: r.cluster for r in ML.assign_clusters(df, [(30, 50, -40), (50, 50, 0)], ML.FEATURES[1:]).collect()}
    assert near == {"1": 0, "2": 1, "4": 0}                              # 4 is as near to both
    risk = {r.id_municipio: (r.risk, r.prediction) for r in ML.score_risk(df, (0.1, 0.0, 0.0), -4.0).collect()}
    assert risk == {"1": (0.731059, 0), "2": (0.268941, 1), "4": (0.5, 0)}
    plan = ML.score_risk(df.withColumn("x", F.lit(1)), (0.1, 0.0, 0.0), -4.0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
