import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.operators.querylog import apply_result_schema, execution_flatten, query_log
from shelfmark.streaming.querylog import KeyIndex, _with_day, append_new, stream_query_log

SCHEMA = (
    "Records array<struct<eventID: string, eventName: string, errorCode: string, eventTime: string, "
    "userIdentity: struct<type: string, principalId: string, userName: string>, "
    "requestParameters: string, responseElements: string>>"
)


def record(i, sql="select 1", name="StartQueryExecution", error=None, kind="IAMUser", day=1):
    return {
        "eventID": f"e{i}",
        "eventName": name,
        "errorCode": error,
        "eventTime": f"2024-01-{day:02d}T00:00:{i:02d}Z",
        "userIdentity": {"type": kind, "principalId": "AROA:role:me", "userName": "name"},
        "requestParameters": None if sql is None else json.dumps({"queryString": sql}),
        "responseElements": None if i == 9 else json.dumps({"queryExecutionId": f"s{i}"}),
    }


RECORDS = [
    record(1), record(2, "SHOW TABLES"), record(3, error="AccessDenied"), record(4, name="GetObject"),
    record(5, kind="AssumedRole", day=2), record(6, None), record(7, "-- SHOW\nselect 2"), record(9),
]


def test_log_keeps_started_queries(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"Records": RECORDS}))
    log = query_log(spark.read.schema(SCHEMA).json(str(tmp_path)))
    assert rows(log, "event_id", "user_name", "session_id") == [
        ("e1", "name", "s1"), ("e5", "role:me", "s5"), ("e7", "name", "s7"), ("e9", "name", None),
    ]


def test_stream_equals_batch_and_drops_replays(spark, tmp_path):
    source, sink, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()

    def run():
        stream_query_log(spark, str(source), SCHEMA, str(sink), str(state)).awaitTermination()
        return rows(spark.read.parquet(str(sink)).drop("event_ts", "event_key", "day", "batch"))

    (source / "a.json").write_text(json.dumps({"Records": RECORDS[:4]}))
    (source / "b.json").write_text(json.dumps({"Records": RECORDS[:2]}))
    first = run()
    (source / "c.json").write_text(json.dumps({"Records": RECORDS}))
    whole = run()
    batch = query_log(spark.read.schema(SCHEMA).json(str(source / "c.json")))
    assert first == [r for r in whole if r[0] == "e1"]
    assert whole == rows(batch)
    assert sorted(p.name for p in sink.iterdir() if p.name.startswith("day")) == ["day=2024-01-01", "day=2024-01-02"]


def test_late_files_lose_nothing(spark, tmp_path):
    """Days in any order over several triggers, replays of old ones, and events without an id."""
    source, sink, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()
    no_id = [record(30, "a", day=3) | {"eventID": None}, record(31, "b", day=3) | {"eventID": None}]
    files = [[record(1, day=20)], [record(2, day=19)], [record(3, day=1), *no_id], [record(4, day=2), *no_id]]
    for n, records in enumerate([*files, files[0]]):
        (source / f"{n}.json").write_text(json.dumps({"Records": records}))
        stream = stream_query_log(spark, str(source), SCHEMA, str(sink), str(state), files_per_trigger=1)
        stream.awaitTermination()
    got = [r[0] for r in rows(spark.read.parquet(str(sink)), "event_id")]
    assert sorted(got, key=str) == [None, None, "e1", "e2", "e3", "e4"]


def batch_of(spark, *records):
    text = spark.createDataFrame([(json.dumps({"Records": list(records)}),)], "j string")
    return _with_day(query_log(text.select(F.from_json("j", SCHEMA).alias("x")).select("x.*")))


def test_replayed_batch_is_known_by_its_number(spark, tmp_path, monkeypatch):
    """A batch that fails after its rows or within its keys, and runs again, leaves each row once."""
    sink = str(tmp_path / "out")
    first = batch_of(spark, record(1), record(2, "select 5", day=2), record(3, day=2))
    append_new(first, sink, "s-0")
    again = batch_of(spark, record(1), record(3, day=2), record(4, day=2), record(4, day=2))

    def broken(self, rows, batch):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(KeyIndex, "add", broken)
        with pytest.raises(RuntimeError):
            append_new(again, sink, "s-1")
    assert rows(spark.read.parquet(sink), "event_id") == [("e1",), ("e2",), ("e3",), ("e4",)]
    for number in ("s-1", "s-0", "s-1", "s-2"):
        append_new(first if number == "s-0" else again, sink, number)
        assert rows(spark.read.parquet(sink), "event_id", "batch") == [
            ("e1", "s-0"), ("e2", "s-0"), ("e3", "s-0"), ("e4", "s-1"),
        ]


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    sink = str(tmp_path / "out")
    many = batch_of(spark, *[record(i % 60, day=1 + i // 60) | {"eventID": f"e{i}"} for i in range(240)])
    append_new(many, sink, "s-0")
    index = KeyIndex(spark, sink)
    there = {p.relative_to(tmp_path / "out" / "_keys").as_posix() for p in (tmp_path / "out" / "_keys").glob("day=*/bucket=*")}
    assert len(there) > 50
    few = batch_of(spark, *[record(i, day=2) | {"eventID": f"e{60 + i}"} for i in range(3)])
    pairs = [(str(r.day), r.b) for r in few.select("day", index.bucket().alias("b")).distinct().collect()]
    held = index.held(pairs, "s-1")
    read = {"/".join(f.split("/_keys/")[1].split("/")[:2]) for f in held.inputFiles()}
    assert read == {f"day={d}/bucket={b}" for d, b in pairs} and len(read) <= 3
    assert {"e60", "e61", "e62"} <= {r.event_key for r in held.collect()}


def test_executions_keep_empty_levels(spark):
    df = spark.createDataFrame(
        [(1, [(10, [(100, (7, "t", "/u")), (101, None)]), (11, [])]), (2, None)],
        "session_id int, batches array<struct<id: int, events: array<struct<id: int, "
        "result: struct<id: int, title: string, url: string>>>>>",
    )
    assert rows(execution_flatten(df), "session_id", "batch_id", "event_id", "result_id") == sorted(
        [(1, 10, 100, 7), (1, 10, 101, None), (1, 11, None, None), (2, None, None, None)], key=repr
    )


def test_short_rows_are_filled(spark):
    df = spark.createDataFrame(
        [(1, [["a", "b"], ["c"]], [("x",), ("y",)])], "id int, rows array<array<string>>, s array<struct<name: string>>"
    )
    got = [(r.row_no, r.row) for r in apply_result_schema(df, "rows", "s").collect()]
    assert got == [(0, {"x": "a", "y": "b"}), (1, {"x": "c", "y": None})]
