"""Pages by key ranges, and ranked search."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.operators import relational, search
from shelfmark.operators.paging import PageIndex
from shelfmark.operators.search import TermIndex
from shelfmark.skew import place_rows


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None, "c'"]), rng.choice([1.5, None, 2.0, float(rng.randrange(50))]), k) for k in range(3000)]
    path = str(tmp_path_factory.mktemp("page") / "t")
    df = spark.createDataFrame(data, "k string, x double, id int")
    df.orderBy("id").write.option("parquet.block.size", 4096).parquet(path)
    return spark.read.parquet(path), data


def ordered(data, order):
    for name in reversed(order):
        at, falling = "k x id".split().index(name.lstrip("-")), name.startswith("-")
        data = sorted(data, key=lambda r: (r[at] is not None, r[at] if r[at] is not None else 0 if at else ""), reverse=falling)
    return data


@pytest.mark.parametrize("order", [["k", "x", "id"], ["-k", "x", "-id"], ["x", "-k", "id"], ["-x", "id"], ["-id"], ["id"]])
def test_pages(table, order):
    df, data = table
    index = PageIndex(df, order, rows=100)
    assert index.ranges.agg({"rows": "sum"}).first()[0] == 3000 and index.ranges.count() > 10
    want = ordered(data, order)
    for limit, offset in ((100, 0), (7, 95), (250, 1234), (50, 2980), (5, 5000), (0, 10)):
        assert [tuple(r) for r in index.page(limit, offset).collect()] == want[offset : offset + limit]


def test_a_page_reads_only_its_ranges(table):
    df, _ = table
    index = PageIndex(df, ["id"], rows=100)
    most = index.ranges.agg({"rows": "max"}).first()[0]
    for offset in (300, 2500):
        read, before = index.rows_of(100, offset)
        assert before <= offset and read.count() <= 100 + 2 * most
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and "GreaterThanOrEqual(id" in plan


def test_equal_keys_are_in_one_range(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "1 as one")
    index = PageIndex(df, ["k"], rows=10)
    assert index.ranges.count() <= 3
    got = [r.k for offset in range(0, 1000, 90) for r in index.page(90, offset).collect()]
    assert got == sorted([i % 3 for i in range(1000)])


def test_pages_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert relational.page_slice(empty, ["k"], 10, 0).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k string, v int")
    assert rows(relational.page_slice(nulls, ["k", "-v"], 1, 1)) == [(None, 1)]


@pytest.mark.parametrize("task_rows", [200_000, 700])
def test_ranges_cost_no_tasks(spark, table, monkeypatch, task_rows):
    monkeypatch.setattr("shelfmark.operators.paging.TASK_ROWS", task_rows)
    df, data = table
    asked = []
    monkeypatch.setattr("shelfmark.operators.paging.place_rows", lambda keys, by, n: asked.append(n) or place_rows(keys, by, n))
    for order in (["-k", "x", "-id"], ["-x", "id"], ["k"]):
        index = PageIndex(df, order, rows=20)
        assert asked.pop() == -(-3000 // task_rows)
        ranges = sorted(index.ranges.select("before", "rows").collect())
        assert ranges[0].before == 0 and all(a.before + a.rows == b.before for a, b in zip(ranges, ranges[1:], strict=False))
        assert sum(r.rows for r in ranges) == 3000
        if order != ["k"]:
            assert 100 < len(ranges) <= 3000 / 20 + 5
            for limit, offset in ((30, 0), (45, 1390), (30, 2980)):
                assert [tuple(r) for r in index.page(limit, offset).collect()] == ordered(data, order)[offset : offset + limit]


TEXTS = [(1, "Gold ring, gold"), (2, "gold"), (3, "golden ring"), (4, None), (5, ""), (None, "ring"), (2, "ring ring")]


@pytest.fixture(scope="module", params=[10_000, 2])
def index(spark, request):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("shelfmark.operators.search.BLOCK", request.param)
        df = spark.createDataFrame(TEXTS, "id int, t string")
        return TermIndex.build(df, "id", "t")


def test_search_equals_the_scan(spark, index):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    merged = df.groupBy("id").agg({"t": "max"}).withColumnRenamed("max(t)", "t").where("not (id <=> 2)").unionByName(
        spark.createDataFrame([(2, "gold ring ring")], "id int, t string")
    )
    for query in ("GOLD ring", "ring", "none", "golden none", "", "gold-ring gold"):
        for mode in ("any", "all"):
            if query:
                scanned = relational.token_search(merged, "t", query.replace("-", " "), mode=mode)
                assert rows(index.search(query, mode), "id") == rows(scanned, "id"), (query, mode)
            else:
                assert index.search(query, mode).count() == 0
    with pytest.raises(ValueError):
        index.search("x", "some")


def test_scores(index):
    gold, ring = math.log1p(6 / 2), math.log1p(6 / 4)
    got = {r.id: (r.n_terms, r.score) for r in index.search("gold ring").collect()}
    want = {1: (2, 2 * gold + ring), 2: (2, gold + 2 * ring), 3: (1, ring), None: (1, ring)}
    assert got == {i: (n, round(s, 4)) for i, (n, s) in want.items()}
    assert [r.id for r in index.search("gold ring", k=2).collect()] == [1, 2]


def test_other_terms_are_pruned(spark):
    df = spark.range(3000).selectExpr("id", "concat('w', id, ' common') as t")
    index = TermIndex.build(df, "id", "t")
    asked = index._asked(["w17"])
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(term,w17)" in plan
    assert index.search("w17", "any").collect()[0].id == 17


def test_a_posting_is_a_row_of_its_own(spark, index):
    """Rows of one id are added up, and no list grows with the table."""
    assert dict(index.postings.dtypes) == {"term": "string", "id": "int", "times": "int", "bucket": "int"}
    assert rows(index.postings, "term", "id", "times") == sorted(
        [("gold", 1, 2), ("ring", 1, 1), ("gold", 2, 1), ("ring", 2, 2), ("golden", 3, 1), ("ring", 3, 1), ("ring", None, 1)], key=repr
    )


def test_words_are_counted_in_their_row_and_shuffled_once(spark):
    df = spark.range(500).selectExpr("id", "concat('b a b w', id % 7, ' a b') as t")
    shuffled = lambda: spark.sparkContext._jsc.sc().newShuffleId()
    before = shuffled()
    index = TermIndex.build(df, "id", "t")
    # ids that are counted (one distinct count) and postings; each call above takes a number too
    assert shuffled() - before - 1 <= 3
    assert rows(index.postings.groupBy("times").count()) == [(1, 500), (2, 500), (3, 500)]
    assert index.postings.count() == 1500


def test_postings_of_rows_read_together_are_one_list(spark):
    df = spark.range(500).coalesce(1).selectExpr("id", "concat('b a b w', id, ' a b') as t")
    index = TermIndex.build(df, "id", "t")
    lists = spark.read.parquet(f"{index.path}/postings")
    # a list of a and one of b, and one for each word that a single text has
    assert lists.count() == 502
    assert rows(lists.where("term < 'w'").selectExpr("term", "times", "size(ids)")) == [("a", 2, 500), ("b", 3, 500)]
    assert index.postings.count() == 1500


ODD = ["", "Él\u212a a_b", " \n", "\u0130i 9-9", "a_b", "x" * 90 + " a_b x", None, "é", "K k\x00K", "a_b\U0001f600a_b", "."]


@pytest.mark.parametrize("size", [1, 20, 1 << 23])
def test_words_of_a_slice_are_those_of_its_texts(spark, monkeypatch, size):
    """Where texts are cut in slices, at odd characters and blank texts, words are as one text has them."""
    df = spark.createDataFrame(list(enumerate(ODD)), "id int, t string").selectExpr("id", "id % 3 as block", "lower(t) as text", "t")
    want = df.select("id", "block", F.explode(text.tokens("t")).alias("term")).groupBy("term", "block", "id").count()
    monkeypatch.setattr(search, "SLICE", size)
    read = df.where("t is not null").select("id", "block", "text").toArrow().to_batches()
    got = [
        (r["term"], r["block"], i, r["times"])
        for b in search._lists(iter(read))
        for r in b.to_pylist()
        for i in r["ids"]
    ]
    assert sorted(got) == sorted(tuple(r) for r in want.collect())
