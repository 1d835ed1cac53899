"""Warehouse extracts in ranges, with filters in the query; the entry module without packages that only the corpus operators need."""

import sqlite3
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from aurum.sources.readers import parquet_reader, read_first_available
from aurum.sources.warehouse import RangePartition, WarehouseReader, ranges, warehouse_reader
from tests.conftest import ROOT

SCHEMA = 'id bigint, "odd name" string, year int'.replace('"', "`")


@pytest.fixture()
def database(tmp_path):
    path = str(tmp_path / "w.db")
    with sqlite3.connect(path) as con:
        con.execute('CREATE TABLE t (id INTEGER, "odd name" TEXT, year INTEGER)')
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(None if i == 50 else i, None if i % 9 == 0 else f"n{i % 4}", 2000 + i % 5)
                                                           for i in range(-5, 300)])
    con.close()
    return path


def _read(spark, path, **how):
    return warehouse_reader("SELECT * FROM t", SCHEMA, "sqlite3", {"database": path}, **how)(spark)


def test_ranges_cover_all_rows_once(spark, database):
    whole = sorted(map(tuple, _read(spark, database).collect()), key=str)
    assert len(whole) == 305
    for n, low, high in ((4, 0, 200), (7, 100, 110), (50, -5, 300), (3, 5, 5)):
        df = _read(spark, database, partition_column="id", lower=low, upper=high, partitions=n)
        assert df.rdd.getNumPartitions() == max(1, min(n, high - low))
        assert sorted(map(tuple, df.collect()), key=str) == whole
    assert ranges("id", 0, 10, 3) == [RangePartition("id", None, 3), RangePartition("id", 3, 6), RangePartition("id", 6, None)]


def test_filters_are_part_of_the_query(spark, database):
    whole = spark.createDataFrame(_read(spark, database).collect(), SCHEMA)
    for filters, condition in (([("year", "=", 2003)], "year = 2003"), ([("id", ">=", 10), ("id", "<", 20)], "id >= 10 AND id < 20"),
                               ([("odd name", "in", ["n1", "n3"])], "`odd name` IN ('n1', 'n3')"), ([("id", "in", [])], "false"),
                               ([("odd name", "is null", None)], "`odd name` IS NULL"),
                               ([("id", "is not null", None), ("odd name", "<>", "n1")], "id IS NOT NULL AND `odd name` <> 'n1'")):
        df = _read(spark, database, partition_column="id", lower=0, upper=300, partitions=3, filters=filters)
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, whole.where(condition).collect()), key=str), condition
    # queries on one frame do not see one another's filters
    df = _read(spark, database)
    assert df.where("year = 2003").count() < df.where("id <= 3 OR year = 2001").count() < df.count() == 305
    reader = WarehouseReader(df.schema, {"query": "SELECT * FROM t", "filters": '[["year", "=", 2003], ["odd name", "in", ["a", "b"]]]'})
    sql, values = reader.statement(RangePartition("id", 3, 6))
    assert sql == ('SELECT "id", "odd name", "year" FROM (SELECT * FROM t) AS extract WHERE "year" = ? AND "odd name" IN (?, ?) '
                   'AND ("id" >= ? AND "id" < ?)') and values == [2003, "a", "b", 3, 6]
    with pytest.raises(ValueError, match="unknown comparison"):
        WarehouseReader(df.schema, {"query": "", "filters": '[["id", "; drop", 1]]'})


def test_the_warehouse_comes_before_its_fall_back(spark, database, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "fall_back"))
    fall_back = parquet_reader(str(tmp_path / "fall_back"))
    ok = warehouse_reader("SELECT * FROM t", SCHEMA, "sqlite3", {"database": database})
    empty = warehouse_reader("SELECT * FROM t WHERE id > 1000", SCHEMA, "sqlite3", {"database": database})
    absent = warehouse_reader("SELECT * FROM t", SCHEMA, "no_such_driver")
    assert read_first_available(spark, [ok, fall_back])[1] == 0
    assert read_first_available(spark, [empty, fall_back])[1] == 1
    assert read_first_available(spark, [absent, fall_back])[1] == 1
    assert _read(spark, database).agg(F.count("id")).first()[0] == 304


@pytest.mark.parametrize("package", ["public_tokenizers", "zstandard", "ahocorasick", "xxhash", "regex"])
def test_entry_goes_on_without_packages_of_the_corpus_operators(package):
    code = (f"import sys; sys.modules[{package!r}] = None\n"
            "import __spark_entry__ as E\n"
            "assert 'state_ranking' in E.queries() and set(E.oracle_sql()) <= set(E.queries())\n"
            "assert not [q for q in E.queries() if q.startswith('op') and q[2].isdigit()]")
    import os
    if os.path.isdir(f"{ROOT}/aurum/llm"):
        subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
