"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import math

import duckdb
import pytest

from tests.conftest import SMALL
from workload import REGISTRY, TABLES, Data


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, bool):
        return int(value)
    return value


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, oracle, name):
    query = REGISTRY[name]
    assert query.sql is not None
    frame = query.run(Data(spark, SMALL))
    columns = sorted(frame.columns)
    got = [tuple(plain(row[c]) for c in columns) for row in frame.collect()]
    result = oracle.execute(query.sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
