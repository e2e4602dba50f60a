"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tillcast.workload.registry import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "benchmark"]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(row[n] for n in order) for row in rows), key=repr)


def test_every_warehouse_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(map(tuple, df.collect()), df.columns) == normal(result.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
