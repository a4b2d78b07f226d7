import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.operators import attributes as A
from shelfmark.operators import catalog as C
from shelfmark.operators import lineage as L
from shelfmark.operators import lookups, quality, schematree, sync
from shelfmark.operators.aggregates import load_summary

FIELDS = [
    (1, "Segment", "PICKER", None, None), (2, "Tier", "MULTI_PICKER", ["gold", "silver"], None),
    (3, "Owners", "OBJECT_SET", None, ["user", "group"]), (8, "segment", "PICKER", None, None),
]
FIELD_SCHEMA = "field_id int, name string, field_type string, options array<string>, allowed_otypes array<string>"


def test_attributes_there_and_back(spark):
    fields = spark.createDataFrame(FIELDS, FIELD_SCHEMA)
    wide = spark.createDataFrame(
        [("t", 1, "a", "u1;u2", "g1"), ("t", 2, None, None, "g2"), ("t", 3, None, None, None)],
        "otype string, id int, SEGMENT string, `owners:user` string, `Owners:group` string",
    )
    long = A.unpivot_attrs(wide, fields)
    assert rows(long, "id", "field_id") == [(1, 1), (1, 3), (2, 3)]
    values = long.selectExpr(
        "otype", "id", "field_id", "posexplode(values) as (ord, v)"
    ).selectExpr("otype", "id", "field_id", "ord", "v.value", "v.otype as value_otype")
    back = A.pivot_attrs(
        values, fields.select("field_id", "name", "field_type"), ["segment", "owners:user", "owners:group"]
    )
    got = rows(back, "id", "part", "segment", "`owners:user`", "`owners:group`")
    assert got == [(1, 0, "a", "u1;u2", "g1"), (2, 0, None, None, "g2")]


def test_headers_options_and_types_are_checked(spark):
    fields = spark.createDataFrame(FIELDS, FIELD_SCHEMA)
    wide = spark.createDataFrame(
        [("t", 1, "old gold", "r1", "?")], "otype string, id int, tier string, `owners:robot` string, other string"
    )
    got = A.unpivot_attrs(wide, fields).collect()
    assert [(r.field_id, [(v.otype, v.value) for v in r["values"]]) for r in got] == [(2, [(None, "gold")])]


def test_object_sets_of_any_size_come_in_parts(spark):
    values = spark.createDataFrame(
        [("t", 1, 3, i, f"u{i}", "user") for i in range(7)],
        "otype string, id int, field_id int, ord int, value string, value_otype string",
    )
    fields = spark.createDataFrame([(3, "Owners", "OBJECT_SET")], "field_id int, name string, field_type string")
    got = A.pivot_attrs(values, fields, ["owners:user"], size=3)
    assert rows(got, "part", "`owners:user`") == [(0, "u0;u1;u2"), (1, "u3;u4;u5"), (2, "u6")]


def test_dump_names_codes_and_blacklist(spark, tmp_path):
    line = {
        "id_": {"databaseCatalog_": {"original_": "DB"}, "schema_": {"original_": "S", "x": 1},
                "table_": {"original_": "T"}, "name_": {"original_": "C.d"}},
        "type_": {"normalized_": 5}, "comment": "dropped",
    }
    other = json.loads(json.dumps(line))
    other["type_"]["normalized_"], other["id_"]["name_"]["original_"] = 99, "E"
    bad = json.loads(json.dumps(line))
    bad["id_"]["schema_"]["original_"] = "HIDDEN"
    (tmp_path / "dump.json").write_text("\n".join(json.dumps(x) for x in (line, other, bad)))
    raw = spark.read.json(str(tmp_path))
    got = C.normalize_dump(raw, C.COLUMN_TYPES, ["db.hidden"], True, "column")
    assert rows(got, "id.name.original", "type.normalized", "lower_schema") == [
        ("C.d", "STRING", "db.s"), ("E", None, "db.s"),
    ]
    assert C.normalize_dump(raw, {}, ["s"], False, "column").count() == 1
    empty = got.where("false")
    schemas = spark.createDataFrame([("db.s",)], "lower_schema string")
    amalgam = C.catalog_amalgam(schemas, empty, got)
    assert rows(amalgam) == [("db.s", "", ""), ("db.s.t.c_d", "", "STRING"), ("db.s.t.e", "", "")]


def test_sheet(spark):
    sheet = spark.createDataFrame(
        [("S", "T", "c", "Text", 1), ("S", "T", "c", "Date", 2), (None, "T", "x", "Text", 3), ("S", None, None, None, 4)],
        "s string, t string, c string, ty string, n int",
    )
    got = C.catalog_from_sheet(sheet, "s", "t", "c", "ty", "9", "n")
    assert rows(got) == [("9.S", None, None), ("9.S.T", "TABLE", None), ("9.S.T.c", None, "Text")]


def test_wide_tables_get_several_statements(spark):
    cols = spark.createDataFrame(
        [("s", "t", f"c{i}", i, "text", i != 2) for i in range(1, 6)],
        "schema_name string, table_name string, attribute_name string, position int, mapped_type string, nullable boolean",
    )
    got = [r.ddl for r in C.table_ddl(cols, size=3).orderBy("part").collect()]
    assert got == [
        'CREATE TABLE IF NOT EXISTS "s"."t"("c1" text,"c2" text NOT NULL,"c3" text)',
        'ALTER TABLE "s"."t" ADD COLUMN "c4" text, ADD COLUMN "c5" text',
    ]


DEEP = [
    {"name": "a", "type": "INT", "description": 'say "hi"'},
    {"name": "b", "type": "RECORD", "mode": "NULLABLE", "fields": [
        {"name": "c", "type": "RECORD", "mode": "REPEATED", "fields": [
            {"name": "d", "type": "RECORD", "fields": [{"name": "e", "type": "STRING"}]}]},
        {"name": "f", "type": "DATE"}]},
]


NESTED = [
    # a list of records, three levels deep, with dots in names
    [
        {"name": "id", "type": "STRING", "description": "key", "examples": ["a", "b"]},
        {"name": "a.b", "type": "RECORD", "mode": "REPEATED", "description": "of \"many\"", "fields": [
            {"name": "c", "type": "RECORD", "fields": [{"name": "d.e", "type": "INT"}, {"name": "f"}]},
        ]},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"},
    ],
    [{"name": "s", "type": "struct", "children": [{"name": "t", "type": "int", "children": [{"name": "u", "type": "x"}]}]}],
    # an API resource
    {"type": "object", "properties": {
        "id": {"type": "integer", "title": "Id", "description": "the id", "examples": [1, {"x": 2}]},
        "items": {"type": "array", "items": {"type": "object", "properties": {"id": {"type": "string"}}}},
        "names": {"type": "array", "items": {"type": "string"}, "description": "all"},
        "deep": {"type": "object", "properties": {"deeper": {"properties": {"leaf": {"type": "null"}}}}},
    }},
    {"items": {"properties": {"only": {"type": "string"}}}},
]


def test_schema_trees_come_back(spark):
    docs = spark.createDataFrame([(f"d{i}", json.dumps(x)) for i, x in enumerate(NESTED)], "doc string, fields string")
    flat = schematree.flatten_schema(docs)
    paths = {d: sorted(r.path for r in flat.where(F.col("doc") == d).collect()) for d in ("d0", "d1", "d2", "d3")}
    assert paths == {
        "d0": ["a.b", "a.b.c", "a.b.c.d.e", "a.b.c.f", "id", "tags"],
        "d1": ["s", "s.t", "s.t.u"],
        "d2": ["deep", "deep.deeper", "deep.deeper.leaf", "id", "items", "items.id", "names"],
        "d3": ["only"],
    }
    encoded = schematree.encode_schema(flat).withColumnRenamed("json", "fields")
    again = schematree.flatten_schema(encoded)
    same = ["doc", "parent", "path", "name", "mode", "title", "description", "examples", "is_leaf", "level"]
    leaf = [*same, F.when(F.col("is_leaf"), F.col("type")).alias("kind")]
    assert rows(again, *leaf) == rows(flat, *leaf)
    third = schematree.encode_schema(again).withColumnRenamed("json", "fields")
    assert rows(third) == rows(encoded)


def test_malformed_schemas_are_named(spark):
    texts = ["[{", "{}", "[]", "[1]", None, '{"properties": {"a": {}}}', '[{"name": "x"}]']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc int, fields string")
    assert rows(schematree.malformed_schemas(docs)) == sorted(
        [(0, "not JSON"), (1, "no fields"), (2, "no fields"), (3, "no fields"), (4, "not JSON")], key=repr
    )
    assert rows(schematree.flatten_schema(docs), "doc", "path") == [(5, "a"), (6, "x")]


def test_schema_rows_in_preorder(spark):
    docs = spark.createDataFrame([("x", json.dumps(DEEP)), ("y", json.dumps(DEEP[:1]))], "doc string, fields string")
    flat = schematree.flatten_schema(docs)
    got = [(r.seq, r.path, r.is_leaf) for r in flat.where("doc = 'x'").orderBy("seq").collect()]
    assert got == [
        (1, "a", True), (2, "b", False), (3, "b.c", False), (4, "b.c.d", False), (5, "b.c.d.e", True), (6, "b.f", True),
    ]
    encoded = {r.doc: json.loads(r.json) for r in schematree.encode_schema(flat).collect()}
    inner = encoded["x"]["properties"]["b"]["properties"]
    assert inner["c"]["type"] == "array" and inner["f"] == {"type": "DATE"}
    assert inner["c"]["items"]["properties"]["d"]["properties"]["e"] == {"type": "STRING"}
    assert encoded["x"]["properties"]["a"] == {"type": "INT", "description": 'say "hi"'}
    assert list(encoded["y"]["properties"]) == ["a"]


def test_plan_applied_leaves_nothing_to_do(spark):
    rng = random.Random(3)
    make = lambda keys: [(k, rng.choice("ab"), rng.choice([None, 1])) for k in keys]
    source = spark.createDataFrame(make(range(0, 40)), "id int, a string, b int")
    target = spark.createDataFrame(make(range(20, 60)), "id int, a string, b int")
    plan = {r.id: r.op for r in sync.sync_plan(source, target, ["id"], ["a", "b"], remove_not_seen=True).collect()}
    have, want = ({r.id: tuple(r) for r in df.collect()} for df in (target, source))
    for key, op in plan.items():
        assert op == ("create" if key < 20 else "delete" if key >= 40 else "keep" if have[key] == want[key] else "update")
    again = sync.sync_plan(source, source, ["id"], ["a", "b"], remove_not_seen=True)
    assert {r.op for r in again.collect()} == {"keep"}
    kept = sync.sync_plan(source, target, ["id"], ["a", "b"]).where("id >= 40")
    assert {r.op for r in kept.collect()} == {"keep"}


def test_one_row_per_key_whatever_the_keys(spark):
    schema = "a string, b int, v string, action string"
    source = [("x", 1, "s", None), ("x", 1, "s", None), (None, 1, "s", None), (None, None, "s", None), ("one", 1, "s", None), ("gone", 1, "s", "delete"), ("never", 1, "s", "delete"), ("dup", 1, "s", "delete")]
    target = [("x", 1, "s", None), ("x", 1, "t", None), (None, 1, "s", None), (None, None, "t", None), ("two", 1, "s", None), ("two", 1, "s", None), ("gone", 1, "s", None), ("dup", 1, "s", None), ("dup", 1, "s", None), ("", 1, "s", None)]
    make = lambda data: spark.createDataFrame(data, schema)
    plan = sync.sync_plan(make(source), make(target), ["a", "b"], ["v"], remove_not_seen=True, action="action").collect()
    got = {(r.a, r.b): (r.op, r.n_source, r.n_target) for r in plan}
    assert len(plan) == len(got)
    assert got == {
        ("x", 1): ("conflict", 2, 2), (None, 1): ("keep", 1, 1), (None, None): ("update", 1, 1), ("one", 1): ("create", 1, 0),
        ("two", 1): ("conflict", 0, 2), ("gone", 1): ("delete", 1, 1), ("dup", 1): ("conflict", 1, 2), ("", 1): ("delete", 0, 1),
    }
    assert sync.sync_plan(make([]), make([]), ["a"], ["v"]).count() == 0


def test_profile_shuffles_hashes_only(spark):
    """A cell takes as many bytes in the shuffle whatever its text."""
    df = spark.range(2000).select(F.concat(F.repeat(F.lit("x"), 3000), F.col("id").cast("string")).alias("wide.text"), (F.col("id") % 7).alias("n"))
    found = {r.col: r for r in quality.profile_columns(df).collect()}
    assert (found["wide.text"].filled, found["wide.text"]["distinct"], found["wide.text"].largest) == (2000, 2000, 1)
    assert (found["n"].filled, found["n"]["distinct"], found["n"].largest) == (2000, 7, 286)
    plan = quality.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    keyed = [x for x in plan.splitlines() if "Exchange hashpartitioning(col" in x]
    assert keyed and all("wide" not in x and "value" not in x for x in keyed)


@pytest.mark.parametrize("sketch", [True, False])
def test_gate_is_open_from_21_to_120_values(spark, sketch, monkeypatch):
    if not sketch:
        monkeypatch.setattr(quality, "SKETCH_SURE", 0)
    df = spark.range(5000).selectExpr(
        *[f"cast(id % {n} as string) as v{n}" for n in (20, 21, 120, 121)], "id as many",
        "if(id < 100, null, 'x') as one",
    )
    got = quality.value_frequency(df, df.columns)
    assert {r.col for r in got.collect()} == {"v21", "v120"}
    assert got.where("col = 'v120'").count() == 10
    assert rows(got.where("col = 'v21' and rank = 1"), "value", "n") == [("0", 239)]
    options = A.picker_fields(df, ["v21", "v20"], prefix="A long prefix for all of it ").collect()
    assert len(options) == 1 and len(options[0].options) == 21 and len(options[0].name) == 25


def test_profile_thresholds(spark):
    df = spark.createDataFrame(
        [(str(i), "same" if i < 6 else None, "five" if i < 5 else None, None, str(i) if i < 10 else None) for i in range(40)],
        "all string, six string, five string, none string, quarter string",
    )
    got = {r.col: (r.filled, r["distinct"], r.largest, r.interesting) for r in quality.profile_columns(df).collect()}
    assert got == {
        "all": (40, 40, 1, True), "six": (6, 1, 6, True), "five": (5, 1, 5, False),
        "none": (0, 0, 0, False), "quarter": (10, 10, 1, False),
    }


def test_rules(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    got = quality.dq_evaluate(df, "k", [("a", "x", "x > 0"), ("b", "x", "x is null or x < 9"), ("c", "no", "no = 1")])
    assert rows(got, "field_key", "status", "value") == [("a", "ALERT", 2), ("b", "GOOD", 0), ("c", "UNKNOWN", None)]


def test_edges_over_all_hops(spark):
    hop = lambda kind, *keys: [(kind, k, k == "tmp") for k in keys]
    path = [hop("table", "a", "tmp"), hop("dataflow", "f"), hop("table", "b"), hop("dataflow", "g"), hop("file", "c")]
    df = spark.createDataFrame(
        [(path,), (path[:2],), (None,)], "path array<array<struct<otype: string, key: string, is_temp: boolean>>>"
    )
    assert rows(L.lineage_edges(df), "src", "dst") == [("a", "f"), ("b", "g"), ("f", "b"), ("g", "c"), ("tmp", "f")]
    assert rows(L.lineage_edges(df, legacy_three_hop=True), "src", "dst") == [("a", "f"), ("f", "b"), ("tmp", "f")]
    titles = spark.createDataFrame([("f", "F")], "dataflow string, title string")
    assert rows(L.tables_with_lineage(df, titles), "key", "side", "dataflow", "title") == [
        ("a", "in", "f", "F"), ("b", "in", "g", None), ("b", "out", "f", "F"),
    ]


def test_mapping_reports_the_unknown_side(spark):
    mapping = spark.createDataFrame(
        [("a", "b"), ("a", "b"), ("x", "b"), ("a", "y"), (None, "b"), ("twice", "b")], "source_table string, target_table string"
    )
    catalog = spark.createDataFrame([("a", "1.a"), ("b", "1.b"), ("twice", "1"), ("twice", "2")], "name string, key string")
    edges, lost = L.lineage_from_mapping(mapping, catalog)
    assert rows(edges, "src", "dst") == [("1.a", "1.b")]
    assert rows(lost) == [("a", "y", "target"), ("twice", "b", "source"), ("x", "b", "source")]


def test_lookups_with_large_dims(spark, no_broadcast):
    df = spark.createDataFrame([(i, "hot" if i < 50 else f"k{i}") for i in range(60)] + [(99, None)], "id int, k string")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k50", 3), (None, 4)], "k string, v int")
    assert {r.id: r.v for r in lookups.unique_lookup(df, dim, "k", "v").collect() if r.v} == {50: 3}
    last = lookups.policy_lookup(df, dim, "k", "v", "v", "last")
    assert {r.v for r in last.where("k = 'hot'").collect()} == {2} and last.count() == 61


def test_job_results(spark):
    df = spark.createDataFrame(
        [("ok", [([("k", 1), ("l", 2)], None), (None, ["e"])]), ("ok", None), ("bad", [(None, ["x", "y"])])],
        "status string, result array<struct<mapping: array<struct<key: string, id: int>>, errors: array<string>>>",
    )
    counts, mapping = load_summary(df)
    assert rows(counts) == [("bad", 1, 0, 2), ("ok", 2, 2, 1)]
    assert rows(mapping) == [("k", 1), ("l", 2)]
