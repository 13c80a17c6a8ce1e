"""Every registered query against its DuckDB statement on the smallest tables."""

import collections
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle.queries import SQL
from tracewarden.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# no Python in the data path, no cross joins
FORBIDDEN = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    return connection


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _bag(rows, places):
    return collections.Counter(tuple(_value(row[i]) for i in places) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = _bag(cursor.fetchall(), [names.index(c) for c in columns])
    assert _bag(df.collect(), [df.columns.index(c) for c in columns]) == expected
