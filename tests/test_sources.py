import datetime as dt
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.session import clear_scratch, hand_over, scratch_path, shared_dir
from shelfmark.sources import readers, writers


def test_csv_with_mark_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        b'\xef\xbb\xbfds;name;note\r\none;"Say ""hi""; ok";"two\nlines"\r\ntwo;name ;\r\n'
    )
    df = readers.scan_csv(spark, str(tmp_path), "ds string, name string, note string", sep=";", multiline=True)
    assert rows(df) == [("one", 'Say "hi"; ok', "two\nlines"), ("two", "name ", None)]


def test_csv_round_trip_keeps_blanks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "b" '), (2, "x,\ny"), (3, None)], "id int, t string")
    writers.write_csv(df, str(tmp_path / "out"))
    assert rows(readers.scan_csv(spark, str(tmp_path / "out"), df.schema, multiline=True)) == rows(df)


def test_json_document(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"schema": {"fields": [\n {"name": "a"},\n {"name": "b", "type": "INT"}]}}')
    df = readers.scan_json_document(
        spark, str(tmp_path), "schema struct<fields: array<struct<name: string, type: string>>>", "schema.fields"
    )
    assert rows(df) == [("a", None), ("b", "INT")]


def test_log_folders_are_pruned(spark, tmp_path):
    data = spark.createDataFrame(
        [(i, "eu" if i % 2 else "us", "2024", f"{m:02d}", f"{d:02d}") for i, (m, d) in enumerate(
            [(1, 31), (2, 1), (2, 1), (2, 2), (12, 1)])],
        "id int, region string, year string, month string, day string",
    )
    writers.write_partitioned(data, ["region", "year", "month", "day"], path=str(tmp_path), fmt="json", codec="gzip")
    df = readers.scan_partitioned_log(
        spark, str(tmp_path), data.schema, "eu", dt.date(2024, 1, 31), dt.date(2024, 2, 2)
    )
    assert rows(df, "id") == [(1,), (3,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def spread(spark, size):
    """Splits of so many bytes for whatever is read in the block."""

    class Held:
        def __enter__(self):
            self.old = spark.conf.get("spark.sql.files.maxPartitionBytes")
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

        def __exit__(self, *_):
            spark.conf.set("spark.sql.files.maxPartitionBytes", self.old)

    return Held()


@pytest.mark.parametrize("size", [9, 64, 100_000])
def test_fields_with_line_breaks_are_read_by_several_tasks(spark, tmp_path, size):
    """Quotes, line breaks and separators fall on every place of the borders of splits."""
    rng = random.Random(size)
    made = ["", "plain", 'say ""x""', "two\nlines", "a;b", '"', '""', "\n", "\n\n", 'end"\n', "é\n𝒳", "\r\n in", "long " * 9 + "\nx\n" * 9]
    schema = "a string, b int, c string"
    for n in range(3):
        lines = ["a;b;c"]
        for k in range({9: 6, 64: 40}.get(size, 300)):
            cell = lambda: '"' + rng.choice(made).replace('"', '""') + '"' if rng.random() < 0.6 else rng.choice(["", "p", "q r"])
            lines.append(f"{cell()};{k};{cell()}" if rng.random() < 0.95 else "")
        end = ["\n", "\n", "\r\n"][n]
        (tmp_path / f"{n}.csv").write_bytes(("\ufeff" if n else "").encode() + (end.join(lines) + (end if n else "")).encode())
    options = {"header": True, "sep": ";", "multiLine": True, "escape": '"'}
    want = rows(spark.read.schema(schema).options(**options).csv(str(tmp_path)))
    with spread(spark, size):
        got = rows(readers.scan_csv(spark, str(tmp_path), schema, sep=";", multiline=True))
    assert got == want and len(want) > 14


def test_one_record_over_many_splits(spark, tmp_path):
    long = "x\n" * 5000
    (tmp_path / "a.csv").write_text(f'a,b\n1,"{long}"\n2,y\n')
    (tmp_path / "b.csv").write_text('a,b\n3,"never closed\n4,z\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b\n")
    with spread(spark, 2500):
        lines = readers.scan_pieces(spark, str(tmp_path / "a.csv"), "\n", "value")
        assert lines.select("block").distinct().count() == 5
        found = readers.scan_csv(spark, str(tmp_path), "a int, b string", multiline=True).collect()
    got = {r.a: r.b for r in found}
    assert got[1] == long and got[2] == "y" and set(got) == {1, 2, 3} and "never closed" in got[3]


@pytest.mark.parametrize("codec", ["snappy", "zstd", "gzip"])
def test_partitioned_table(spark, tmp_path, codec):
    data = spark.range(100).withColumn("day", (F.col("id") % 3).cast("int"))
    table = f"parts_{codec}"
    writers.write_partitioned(data, ["day"], path=str(tmp_path / codec), table=table, codec=codec)
    assert rows(spark.table(table)) == rows(data)
    names = [p.name for p in (tmp_path / codec).rglob("*.parquet")]
    assert names and all(codec in n or (codec == "gzip" and ".gz." in n) for n in names)
    spark.sql(f"DROP TABLE {table}")


def test_pages(spark):
    pages = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 1, 2, "new"), ("b", 1, 1, "x"), ("a", 2, 3, "y")],
        "otype string, id int, page int, v string",
    )
    assert rows(readers.page_union(pages, ["otype", "id"], "page"), "otype", "id", "v") == [
        ("a", 1, "new"), ("a", 2, "y"), ("b", 1, "x"),
    ]


def test_spine_has_every_day_of_a_leap_year(spark):
    spine = writers.partition_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 12, 31), ["a", "b"], "s3/logs")
    assert spine.count() == 732
    assert spine.where("month = '02' and day = '29' and region = 'b'").first().location == "s3/logs/b/2020/02/29/"
    present = spine.where("month <> '03'")
    missing = writers.missing_partitions(spine, present, ["region", "date"])
    assert missing.count() == 62


def test_inventory_skips_empty_files(spark, tmp_path):
    for name, text in (("a/b/one.txt", "12345"), ("a/two.txt", "1"), ("top.txt", "22"), ("a/b/empty.txt", "")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    df = readers.file_inventory(spark, str(tmp_path))
    assert rows(df, "top", "second", "size") == sorted(
        [("a", "b", 5), ("a", None, 1), (None, None, 2)], key=repr
    )


def test_json_lines_leave_nulls_out(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert writers.to_ndjson(df).first().value == '{"a":1,"c":"x"}'
    assert writers.to_ndjson(df, ["c"]).first().value == '{"c":"x"}'


def test_jdbc_needs_bounds(spark):
    with pytest.raises(ValueError):
        readers.scan_jdbc(spark, "jdbc:none:x", "select 1", partition_column="id")


def test_shared_folder_is_the_one_configured(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured


def test_what_was_handed_over_can_be_deleted(spark):
    kept = hand_over(spark.range(3), "numbers")
    folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
    assert kept.count() == 3 and folder.exists()
    clear_scratch(spark)
    assert not folder.exists()
