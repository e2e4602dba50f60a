"""Queries that SQL can express, against their SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tillcast.llm.queries import QUERIES, QUERIES_SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.mark.parametrize("name", QUERIES_SQL)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        duck.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    result = duck.execute(QUERIES_SQL[name])
    columns = [c[0] for c in result.description]
    rows = QUERIES[name](spark, FOLDER).select(columns).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, result.fetchall()))
