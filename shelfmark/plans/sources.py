"""Registered queries: readers, writers, batches and calendars."""

import datetime as dt

from pyspark.sql import functions as F

from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query
from shelfmark.session import scratch_path
from shelfmark.sources import readers, writers


@query("scan_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv(t):
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.documents, path)
    return readers.scan_csv(t.spark, path, t.documents.schema, multiline=True)


@query(
    "scan_csv_semicolon",
    "SELECT * FROM part",
)
def scan_csv_semicolon(t):
    path = scratch_path(t.spark, "csv")
    t.part.write.option("header", True).option("sep", ";").csv(path)
    return readers.scan_csv(t.spark, path, t.part.schema, sep=";")


@query("scan_ndjson_nested", "SELECT conv_id, turn, role, text AS com FROM conversations")
def scan_ndjson_nested(t):
    path = scratch_path(t.spark, "ndjson")
    threads = X.threads(t)
    threads.write.json(path)
    posts = readers.scan_ndjson_nested(t.spark, path, threads.schema)
    return posts.select("conv_id", F.explode("posts").alias("p")).select(
        "conv_id", "p.turn", "p.role", "p.com"
    )


@query("scan_parquet", "SELECT * FROM supplier")
def scan_parquet(t):
    return readers.scan_parquet(t.spark, f"{t.folder}/supplier.parquet")


def _partitioned_events(t, path):
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    events = t.events.select(
        "event_id", "event_type", "user_id", F.lit("eu-1").alias("region"),
        *[F.date_format("ts", f).alias(c) for c, f in parts.items()],
    )
    writers.write_partitioned(
        events, ["region", "year", "month", "day"], path=path, fmt="json", codec="gzip"
    )


@query(
    "scan_partitioned_log",
    """SELECT event_id, event_type, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'""",
)
def scan_partitioned_log(t):
    path = scratch_path(t.spark, "log")
    _partitioned_events(t, path)
    days = readers.scan_partitioned_log(
        t.spark,
        path,
        "event_id bigint, event_type string, user_id bigint, "
        "region string, year string, month string, day string",
        "eu-1",
        dt.date(2024, 1, 10),
        dt.date(2024, 1, 20),
    )
    return days.select(
        "event_id", "event_type", "user_id", F.concat_ws("-", "year", "month", "day").alias("day")
    )


@query(
    "scan_json_document",
    "SELECT 'd' || p_size AS doc, 'f' || p_partkey AS name, p_type AS type FROM part",
)
def scan_json_document(t):
    path = scratch_path(t.spark, "json")
    field = F.struct(
        F.concat(F.lit("d"), F.col("p_size").cast("string")).alias("doc"),
        F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_type").alias("type"),
    )
    # documents of 100 fields, written over several lines
    docs = t.part.groupBy(F.floor(F.col("p_partkey") / 100)).agg(
        F.struct(F.collect_list(field).alias("fields")).alias("schema")
    )
    docs.select(F.to_json(F.struct("schema"), {"pretty": "true"})).repartition(8).write.option(
        "lineSep", "\n\n"
    ).option("maxRecordsPerFile", 1).text(path)
    return readers.scan_json_document(
        t.spark,
        path,
        "schema struct<fields: array<struct<doc: string, name: string, type: string>>>",
        "schema.fields",
    )


@query(
    "page_union",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'late' ELSE 'early' END AS state,
       o_totalprice AS price FROM orders""",
)
def page_union(t):
    early = t.orders.select(
        F.col("o_orderkey").alias("id"), F.lit("early").alias("state"),
        F.col("o_totalprice").alias("price"),
        F.floor(F.col("o_orderkey") / 100).alias("page"), "o_orderstatus",
    )
    late = early.where("o_orderstatus = 'P'").withColumn("state", F.lit("late")).withColumn(
        "page", F.col("page") + 1_000_000_000
    )
    path = scratch_path(t.spark, "pages")
    early.unionByName(late).write.json(path)
    pages = t.spark.read.schema(early.schema).json(path)
    return readers.page_union(pages, ["id"], "page").drop("page", "o_orderstatus")


@query(
    "write_partitioned",
    """SELECT event_id, value, year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events""",
)
def write_partitioned(t):
    path = scratch_path(t.spark, "parts")
    rows = t.events.select(
        "event_id", "value", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.day("ts").alias("day"),
    )
    writers.write_partitioned(rows, ["year", "month", "day"], path=path, codec="zstd")
    return t.spark.read.parquet(path)


@query("write_csv", "SELECT * FROM customer")
def write_csv(t):
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.customer, path)
    return readers.scan_csv(t.spark, path, t.customer.schema)


@query(
    "to_ndjson",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"'
       || (CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END)
       || '}' AS value FROM customer""",
)
def to_ndjson(t):
    return writers.to_ndjson(
        t.customer.select(
            "c_custkey", "c_name",
            F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"),
        )
    )


@query(
    "chunk_rows",
    """SELECT (rn - 1) // 100 AS chunk, count(*) AS n, string_agg(p_name, '|' ORDER BY rn) AS body
       FROM (SELECT p_name, row_number() OVER (ORDER BY p_name, p_partkey) AS rn FROM part)
       GROUP BY 1""",
)
def chunk_rows(t):
    chunks = writers.chunk_rows(t.part, 100, ["p_name", "p_partkey"])
    return writers.chunk_bodies(chunks, "p_name", "|")


@query(
    "partition_spine",
    """SELECT 'eu-1' AS region, strftime(d, '%Y') AS year, strftime(d, '%m') AS month,
       strftime(d, '%d') AS day, 'logs/eu-1/' || strftime(d, '%Y/%m/%d') || '/' AS location
       FROM (SELECT CAST(range AS DATE) AS d
             FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2025-01-01', INTERVAL 1 DAY))
       WHERE d NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
)
def partition_spine(t):
    spine = writers.partition_spine(
        t.spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31), ["eu-1"], "logs"
    )
    present = t.events.select(F.col("ts").cast("date").alias("date"))
    return writers.missing_partitions(spine, present, ["date"]).drop("date")


@query(
    "file_inventory",
    """SELECT 'year=' || year(ts) AS top, 'month=' || month(ts) AS second,
       CAST(sum(length('' || event_id) + 1) AS BIGINT) AS bytes, true AS inside FROM events GROUP BY 1, 2""",
)
def file_inventory(t):
    path = scratch_path(t.spark, "inventory")
    rows = t.events.select(
        F.col("event_id").cast("string").alias("value"),
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"),
    )
    writers.write_partitioned(rows, ["year", "month", "day"], path=path, fmt="text", codec="none")
    files = readers.file_inventory(t.spark, path)
    inside = F.contains("path", F.concat_ws("/", F.lit(""), "top", "second", F.lit("day=")))
    return files.groupBy("top", "second").agg(F.sum("size").alias("bytes"), F.bool_and(inside).alias("inside"))
