"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shelfmark.plans import REGISTRY
from shelfmark.plans.registry import TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in queries().items() if name in REGISTRY}
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in SQL:
        found = duck.execute(SQL[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    else:
        assert got


def test_entry(spark):
    assert entry(spark).columns == ["term", "count"]


def test_sql_has_a_query_each():
    assert set(SQL) <= set(queries()) and set(REGISTRY) <= set(queries())
