"""Warehouse extracts through any DB-API driver, read in parallel: a Spark data source named ``aurum_warehouse``.

    spark.dataSource.register(WarehouseSource)
    spark.read.format("aurum_warehouse").schema("id bigint, year int").options(
        driver="duckdb", connect='{"database": ":memory:"}', query="SELECT ...",
        partitionColumn="id", lowerBound="0", upperBound="1000000", numPartitions="16").load()

Each input partition opens its own connection in its task and reads one range of ``partitionColumn`` (the first also takes
nulls, the first and the last are open), so no row passes through the driver.  A lost task reads its range again.  The
driver must take ``?`` parameters.

``filters`` (a JSON list of ``[column, comparison, value]``) go into the query's WHERE clause as parameters, so the
warehouse leaves the other rows out.  They are stated by the caller: filters that Spark pushes to a Python source stay
with the frame that was loaded, and a second query on it without filters would get the first one's rows.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as DS
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_PER_BATCH = 10_000
COMPARISONS = ("=", "<>", "<", "<=", ">", ">=")


def _name(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def condition(column: str, comparison: str, value) -> tuple[str, list]:
    """SQL text and parameters of one filter: a comparison, ``in`` a list, ``is null`` or ``is not null``."""
    if comparison in COMPARISONS:
        return f"{_name(column)} {comparison} ?", [value]
    if comparison == "in":
        return f"{_name(column)} IN ({', '.join('?' * len(value))})" if value else "1 = 0", list(value)
    if comparison in ("is null", "is not null"):
        return f"{_name(column)} {comparison.upper()}", []
    raise ValueError(f"unknown comparison {comparison!r}")


@dataclass
class RangePartition(DS.InputPartition):
    """Rows whose partition column is at least ``low`` and below ``high``; an open end takes all beyond it."""

    column: str | None = None
    low: int | None = None
    high: int | None = None

    def condition(self) -> tuple[str, list]:
        if self.column is None or (self.low is None and self.high is None):
            return "", []
        name = _name(self.column)
        if self.low is None:
            return f"({name} < ? OR {name} IS NULL)", [self.high]
        if self.high is None:
            return f"{name} >= ?", [self.low]
        return f"({name} >= ? AND {name} < ?)", [self.low, self.high]


def ranges(column: str | None, low: int, high: int, n: int) -> list[RangePartition]:
    """At most ``n`` ranges of about equal width that cover all values and nulls."""
    n = max(1, min(n, high - low))
    if column is None or n == 1:
        return [RangePartition()]
    cuts = [low + (high - low) * i // n for i in range(1, n)]
    return [RangePartition(column, a, b) for a, b in zip([None, *cuts], [*cuts, None])]


class WarehouseReader(DS.DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, options
        self.where = [condition(*f) for f in json.loads(options.get("filters", "[]"))]

    def partitions(self) -> list[RangePartition]:
        o = self.options
        return ranges(o.get("partitioncolumn"), int(o.get("lowerbound", 0)), int(o.get("upperbound", 0)),
                      int(o.get("numpartitions", 1)))

    def statement(self, partition: RangePartition) -> tuple[str, list]:
        """The query of one partition and its parameters."""
        parts = [(sql, values) for sql, values in [*self.where, partition.condition()] if sql]
        columns = ", ".join(_name(c) for c in self.schema.fieldNames())
        where = " WHERE " + " AND ".join(sql for sql, _ in parts) if parts else ""
        return f"SELECT {columns} FROM ({self.options['query']}) AS extract{where}", [v for _, values in parts for v in values]

    def read(self, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        driver = importlib.import_module(self.options["driver"])
        connection = driver.connect(**json.loads(self.options.get("connect", "{}")))
        try:
            cursor = connection.cursor()
            cursor.execute(*self.statement(partition))
            schema = to_arrow_schema(self.schema)
            while rows := cursor.fetchmany(ROWS_PER_BATCH):
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        finally:
            connection.close()


class WarehouseSource(DS.DataSource):
    @classmethod
    def name(cls) -> str:
        return "aurum_warehouse"

    def schema(self) -> str:
        raise ValueError("declare the extract's schema with .schema(...)")

    def reader(self, schema: StructType) -> WarehouseReader:
        return WarehouseReader(schema, {k.lower(): v for k, v in self.options.items()})


def warehouse_reader(query: str, schema: str, driver: str, connect: dict | None = None, partition_column: str | None = None,
                     lower: int = 0, upper: int = 0, partitions: int = 1, filters=()):
    """A reader for ``read_first_available``: the query's rows that pass ``filters``, in ranges of ``partition_column``."""

    def read(spark: SparkSession) -> DataFrame:
        importlib.import_module(driver).connect(**(connect or {})).close()  # a warehouse that cannot be opened fails here
        spark.dataSource.register(WarehouseSource)
        options = {"query": query, "driver": driver, "connect": json.dumps(connect or {}), "lowerBound": lower,
                   "upperBound": upper, "numPartitions": partitions, "filters": json.dumps(list(filters))}
        if partition_column:
            options["partitionColumn"] = partition_column
        return spark.read.format("aurum_warehouse").schema(schema).options(**options).load()

    return read
