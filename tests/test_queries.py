"""Every registered query against its SQL equivalent, on the smallest tables."""

import importlib.util
from pathlib import Path

import duckdb
import pandas as pd
import pytest

SF_DIR = Path("/root/testdata/sf0.001")
ENTRY = Path(__file__).parent.parent / "__spark_entry__.py"

spec = importlib.util.spec_from_file_location("entry", ENTRY)
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SF_DIR.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def plain(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        return str(pd.Timestamp(value)) if hasattr(value, "year") else str(value)

    return sorted(tuple(text(record[i]) for i in order) for record in records)


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = entry.queries()[name](spark, str(SF_DIR))
    expected = duck.sql(entry.oracle_sql()[name])
    assert sorted(found.columns) == sorted(expected.columns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert costly not in plan
    records = [tuple(row) for row in found.collect()]
    assert records
    assert plain(found.columns, records) == plain(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 10
