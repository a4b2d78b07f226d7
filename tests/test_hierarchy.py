import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.operators import hierarchy as H
from shelfmark.operators.hierarchy import orphans

SCHEMA = "id string, parent string, name string"


def tree(spark, edges):
    return spark.createDataFrame([(i, p, i) for i, p in edges], SCHEMA)


def random_tree(seed, n):
    rng = random.Random(seed)
    ids = [f"n{i:03d}" for i in rng.sample(range(1000), n)]
    return [(ids[0], None)] + [(ids[i], ids[rng.randrange(i)]) for i in range(1, n)]


def test_paths_orphans_and_cycles(spark):
    nodes = tree(
        spark,
        [("a", None), ("b", "a"), ("c", "b"), ("lost", "gone"), ("below", "lost"),
         ("x", "y"), ("y", "z"), ("z", "x"), ("tail", "x"), ("self", "self")],
    )
    found = {r.id: r for r in H.ancestry(nodes, "id", "parent", ["name"]).collect()}
    status = {i: r.status for i, r in found.items()}
    assert status == {
        "a": "ok", "b": "ok", "c": "ok", "lost": "missing parent", "below": "missing parent",
        "x": "cycle", "y": "cycle", "z": "cycle", "tail": "cycle", "self": "cycle",
    }
    assert [t.node for t in found["c"].trail] == ["a", "b", "c"]
    paths = {r.id: r.path for r in H.folder_path(nodes, "id", "parent", "name").collect()}
    assert paths["c"] == "a//b//c" and paths["below"] == "" and paths["tail"] == ""


@pytest.mark.parametrize("depth", [1, 2, 300])
def test_any_depth(spark, depth):
    chain = [("0", None)] + [(str(i), str(i - 1)) for i in range(1, depth)]
    levels = H.creation_levels(tree(spark, chain), "id", "parent")
    assert {int(r.id): r.level for r in levels.collect()} == {i: i for i in range(depth)}


def test_levels_start_below_existing_nodes(spark):
    nodes = tree(spark, [("b", "a"), ("c", "b"), ("d", "gone")])
    existing = spark.createDataFrame([("a",)], "id string")
    got = {r.id: (r.level, r.status) for r in H.creation_levels(nodes, "id", "parent", existing).collect()}
    assert got == {"b": (0, "ok"), "c": (1, "ok"), "d": (None, "missing parent")}


def children_of(edges):
    below = {}
    for i, p in sorted(edges):
        below.setdefault(p, []).append(i)
    return below


def by_seq(df):
    return [r.id for r in sorted(df.collect(), key=lambda r: r.seq)]


@pytest.mark.parametrize("seed", [1, 2])
def test_preorder_from_any_root(spark, seed, no_broadcast):
    edges = random_tree(seed, 60)
    below, root = children_of(edges), edges[7][0]
    todo, order = sorted(i for i, _ in edges if i != root), [root]
    while todo:
        for child in reversed(below.get(order[-1], [])):
            if child in todo:
                todo.remove(child)
                todo.insert(0, child)
        order.append(todo.pop(0))
    assert by_seq(H.preorder(tree(spark, edges), "id", "parent", "name", root)) == order


@pytest.mark.parametrize("seed", [3, 4])
def test_postorder(spark, seed):
    edges = random_tree(seed, 60)
    below, leaves, inner = children_of(edges), [], []

    def visit(node):
        if node in below:
            for child in below[node]:
                visit(child)
            inner.append(node)
        else:
            leaves.insert(0, node)

    visit(edges[0][0])
    got = by_seq(H.postorder(tree(spark, edges), "id", "parent", "name", edges[0][0]))
    assert got == leaves + inner


def test_orphans_and_their_children(spark, no_broadcast):
    nodes = tree(spark, [("a", None), ("b", "a"), ("r", "gone"), ("c", "r"), ("d", "c")])
    assert rows(orphans(nodes, "id", "parent"), "id", "reason") == [
        ("c", "parent left out"), ("d", "parent left out"), ("r", "parent missing"),
    ]


def test_prefixes_are_trimmed_and_distinct(spark):
    df = spark.createDataFrame([("A / B/C",), ("A/B",), (None,)], "path string")
    assert rows(H.path_prefixes(df, "path")) == [
        ("A", None, 1), ("A/B", "A", 2), ("A/B/C", "A/B", 3),
    ]


def test_external_ids(spark):
    df = spark.createDataFrame(
        [
            ("bi_folder", "F", None, None), ("bi_folder", "G", "F", None),
            ("bi_folder", "X", "nowhere", None), ("bi_folder", "D", None, "delete"),
            ("bi_report", "R", "F//G", ""), ("bi_report_column", "C", "F//G||R", None),
        ],
        "otype string, name string, parent string, action string",
    )
    got = {r.name: r for r in H.assign_external_ids(df, n=6).collect()}
    assert "D" not in got and got["X"].external_id is None
    assert got["R"].fully_qualified_name == "F//G||R"
    assert got["R"].parent_folder == got["G"].external_id and got["R"].report is None
    assert got["C"].report == got["R"].external_id and got["C"].parent_folder is None
    assert {len(r.external_id) for n, r in got.items() if n != "X"} == {6}
    again = {r.name: r.external_id for r in H.assign_external_ids(df.orderBy("name"), n=6).collect()}
    assert again == {n: r.external_id for n, r in got.items()}


def test_remap_leaves_out_links_already_there(spark):
    schema = "id int, title string, children array<int>"
    source = spark.createDataFrame(
        [(1, "P", [2, 3, 4, 99]), (2, "A", []), (3, "B", []), (4, "new", [])], schema
    )
    target = spark.createDataFrame(
        [(10, "P", [20]), (20, "A", []), (31, "B", []), (30, "B", [])], schema
    )
    assert rows(H.remap_children(source, target)) == [(10, 0, [30])]


def test_digest_shows_the_first_reports_only(spark):
    folders = spark.createDataFrame([("f",), ("empty",)], "external_id string")
    reports = spark.createDataFrame([(f"r{i:02d}", "f") for i in range(30)], "id string, parent_folder string")
    got = {r.external_id: r for r in H.folder_digest(folders, reports).collect()}
    assert got["f"].reports == 30 and got["f"].description.count("<a ") == 25
    assert got["empty"].description == "<p>There are 0 reports in this folder. Showing max 25.</p>"


def test_a_deep_chain_has_levels(spark):
    nodes = spark.range(100_000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent"),
    )
    cycle = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "b"), ("d", "gone")], "id string, parent string")
    found = H.creation_levels(nodes.unionByName(cycle), "id", "parent")
    assert found.where("status = 'ok' and level != cast(id as int)").isEmpty()
    assert found.where("status = 'ok'").count() == 100_000
    lost = found.where("status != 'ok'")
    assert rows(lost, "id", "status", "level") == [
        ("a", "cycle", None), ("b", "cycle", None), ("c", "cycle", None), ("d", "missing parent", None),
    ]
