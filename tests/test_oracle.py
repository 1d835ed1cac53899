"""Every registered query against its reference SQL on DuckDB (smallest scale)."""

import pytest

from tools.compare import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, verbose=False)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "classificacao_politica_publica" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_every_query_runs(results):
    errors = {k: v["error"] for k, v in results.items() if "error" in v}
    assert not errors


def test_every_oracle_matches(results):
    bad = {k: v for k, v in results.items() if "duck_rows" in v
           and not (v["cols_ok"] and v["values_ok"] and v["spark_rows"] == v["duck_rows"])}
    assert not bad
