"""Property tests: operators against brute-force Python models on random inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aurum import config as C
from aurum.functions.rounding import round_half_up
from aurum.operators import quality as Q
from aurum.operators.dedupe import latest_per_key

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

ids = st.one_of(st.none(), st.text(alphabet="0123456789x", min_size=0, max_size=9))
ufs = st.one_of(st.none(), st.sampled_from(["SP", "rj", "CE"]))
years = st.one_of(st.none(), st.integers(2019, 2031))
rates = st.one_of(st.none(), st.floats(-10, 120), st.just(float("nan")), st.just(100.0), st.just(0.0))
scores = st.one_of(st.none(), st.floats(-10, 1100, allow_nan=False), st.just(1000.0))
rows = st.lists(st.tuples(ids, ufs, years, rates, scores), min_size=1, max_size=25)


def model_reason(r):
    i, u, y, rate, score = r
    if i is None or u is None or y is None:
        return C.REASON_COMPLETENESS
    ok_rate = rate is not None and rate == rate and 0 <= rate <= 100
    ok_score = score is not None and 0 <= score <= 1000
    if not (ok_rate and ok_score):
        return C.REASON_ACCURACY
    if not (len(i) == 7 and i.isdigit()):
        return C.REASON_VALIDITY
    return None


@SETTINGS
@given(rows)
def test_split_matches_the_rule_model(spark, data):
    df = spark.createDataFrame(data, "id_municipio string, sigla_uf string, ano int, "
                                     "indicador_alfabetizacao double, media_proficiencia_saeb double")
    flagged = Q.evaluate(df)
    got = sorted((r.rejection_reason or "") for r in flagged.collect())
    want = sorted((model_reason(r) or "") for r in data)
    assert got == want
    clean, quarantine = Q.split(df, stamp=False)
    assert clean.count() + quarantine.count() == len(data)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=40))
def test_latest_per_key_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, ts int, v int").repartition(3)
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts"]).collect())
    best = {}
    for k, ts, v in data:
        if k not in best or (ts, v) > best[k]:
            best[k] = (ts, v)
    assert got == sorted((k, ts, v) for k, (ts, v) in best.items())


@SETTINGS
@given(st.lists(st.decimals(min_value=-10000, max_value=10000, places=3, allow_nan=False,
                            allow_infinity=False), min_size=1, max_size=30))
def test_round_half_up_on_the_decimal_value(spark, data):
    vals = [float(d) for d in data]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(round_half_up("x").alias("y")).collect()]
    want = [float(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in vals]
    assert got == want
