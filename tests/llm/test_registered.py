"""The registered queries of this package against their SQL, and without cross joins."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from shelfmark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"
TABLES = ("documents", "benchmark", "labels", "conversations", "embeddings")


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(name, spark):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(cols).collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    found = con.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall()) and got


OTHER_ROWS = ("op1_decontaminate", "op4_chat_format", "op8_secret_scan", "op11_spelling_variants", "op13_top_products")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in OTHER_ROWS])
def test_one_row_per_document(name, spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert QUERIES[name](spark, FOLDER).count() == docs
