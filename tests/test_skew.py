import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark import skew
from shelfmark.operators import aggregates, relational
from shelfmark.sources import writers


@pytest.fixture(autouse=True, params=[1, 10_000], ids=["cut", "whole"])
def split_rows(request, monkeypatch):
    """Once with groups cut at any size, once with none cut."""
    monkeypatch.setattr(skew, "SPLIT_ROWS", request.param)
    return request.param


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows has one key, some have none."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(200)}"
        data.append((i, key, rng.randrange(40)))
    return spark.createDataFrame(data, "id int, key string, v int").repartition(5)


def test_number_rows_is_the_sorted_position(hot):
    got = {r.id: r.rn for r in skew.number_rows(hot, ["v", F.desc("id")]).collect()}
    order = sorted(hot.collect(), key=lambda r: (r.v, -r.id))
    assert got == {r.id: n for n, r in enumerate(order, 1)}


def test_number_in_groups_with_a_group_over_several_ranges(hot):
    got = {r.id: r.rn for r in skew.number_in_groups(hot, ["key"], ["v", "id"]).collect()}
    seen = {}
    for r in sorted(hot.collect(), key=lambda r: (r.key or "", r.v, r.id)):
        seen[r.key] = seen.get(r.key, 0) + 1
        assert got[r.id] == seen[r.key]
    assert len(got) == 3000


def test_one_group_only(spark):
    df = spark.range(1000).select("id", F.lit("x").alias("key"))
    got = {r.id: r.rn for r in skew.number_in_groups(df, ["key"], [F.desc("id")]).collect()}
    assert got == {i: 1000 - i for i in range(1000)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "key string, id int")
    assert skew.number_rows(empty, ["id"]).count() == 0
    assert skew.number_in_groups(empty, ["key"], ["id"]).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_of_hot_and_null_keys(hot, no_broadcast, how):
    dim = no_broadcast.createDataFrame(
        [("hot", 1)] + [(f"k{i}", i) for i in range(0, 200, 2)] + [(None, 9)], "key string, w int"
    )
    got = skew.lookup_join(hot, dim, "key", how)
    want = hot.join(dim, "key", how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_lookup_with_several_matches(hot, no_broadcast):
    dim = no_broadcast.createDataFrame([("hot", 1), ("hot", 2), ("k4", 3)], "key string, w int")
    assert rows(skew.lookup_join(hot, dim, ["key"], "inner")) == rows(hot.join(dim, "key"))


def test_hot_keys_are_found_by_their_count(hot, spark, split_rows):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        found = skew.crowded(hot, ["key"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    if split_rows == 1:
        assert [r.key for r in found if r.key] == ["hot"]
    else:
        assert found == []


def test_keys_of_different_types(hot, no_broadcast):
    left = hot.selectExpr("id", "v % 3 as k")
    right = no_broadcast.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    assert rows(skew.lookup_join(left, right, "k")) == rows(left.join(right, "k", "left"))


def test_lists_of_a_hot_group_come_in_parts(hot):
    lists = aggregates.collect_children(hot.where("key is not null"), "key", "id", size=100)
    parts = {r.part: r.children for r in lists.where("key = 'hot'").collect()}
    assert sorted(parts) == list(range(10))
    assert [i for p in sorted(parts) for i in parts[p]] == list(range(0, 3000, 3))


def test_chunks_have_the_same_size(hot):
    chunks = writers.chunk_rows(hot, 70, ["id"])
    sizes = {r.chunk: r["count"] for r in chunks.groupBy("chunk").count().collect()}
    assert sizes == {i: 70 for i in range(42)} | {42: 60}
    assert chunks.where("id = 70").select("chunk", "pos").first() == (1, 1)


def test_deep_page_equals_sorted_slice(hot):
    page = relational.page_slice(hot, ["v", "id"], 5, 20_000)
    assert page.count() == 0
    order = sorted((r.v, r.id) for r in hot.collect())
    for offset in (0, 100, 2990):
        page = relational.page_slice(hot, ["v", "id"], 7, offset)
        assert [(r.v, r.id) for r in page.collect()] == order[offset : offset + 7]


@pytest.mark.parametrize("n", [1, 5, 2000])
def test_top_rows_of_each_group(hot, n):
    got = aggregates.top_n_per_group(hot, ["key"], [F.desc("v"), F.asc("id")], n)
    want, seen = [], {}
    for r in sorted(hot.collect(), key=lambda r: (-r.v, r.id)):
        seen[r.key] = seen.get(r.key, 0) + 1
        if seen[r.key] <= n:
            want.append((r.id, r.key, r.v, seen[r.key]))
    assert rows(got) == sorted(want, key=repr)
    assert dict(got.dtypes)["rank"] == "bigint"


def test_all_but_the_first_copy(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "k string, id int")
    kept = aggregates.duplicate_keys(df, ["k"], keep="first", order=["id"])
    assert rows(kept) == [("a", 2), ("a", 3)]
    assert rows(aggregates.duplicate_keys(df, ["k"])) == [("a", 3)]


def test_threads_of_any_length_have_one_root(spark):
    """A thread takes several nested rows; its root and size are those of the whole thread."""
    from shelfmark.plans import REGISTRY
    from shelfmark.plans.registry import Tables

    turns = spark.range(1500).selectExpr("id as turn").crossJoin(
        spark.createDataFrame([(1, 130), (2, 1500), (3, 1)], "conv_id bigint, n int")
    ).where("turn < n").selectExpr("conv_id", "turn", "'user' as role", "'text' as text")
    tables = Tables(spark, "/nowhere")
    tables.conversations = turns
    got = REGISTRY["thread_root_nested"].run(tables).groupBy("ori_post", "replies_top").count()
    assert set(rows(got)) == {(1 << 32, 130, 130), (2 << 32, 1500, 1500), (3 << 32, 1, 1)}
