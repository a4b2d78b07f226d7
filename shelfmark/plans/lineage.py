"""Registered queries: lineage paths, SQL texts and query logs."""

from pyspark.sql import functions as F

from shelfmark.operators import lineage as L
from shelfmark.operators import projects as P
from shelfmark.operators import querylog as G
from shelfmark.operators import sqltext as S
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query
from shelfmark.session import scratch_path
from shelfmark.streaming.querylog import stream_query_log


_HALVES = """SELECT src_otype, src, dataflow, 'dataflow' AS dst_otype, dataflow AS dst FROM edges
    UNION SELECT 'dataflow', dataflow, dataflow, dst_otype, dst FROM edges"""


@query("lineage_edges", f"WITH {X.EDGES} {_HALVES}")
def lineage_edges(t):
    return L.lineage_edges(X.dataflows(t))


@query(
    "lineage_edges_three_hop",
    f"WITH {X.EDGES} SELECT * FROM ({_HALVES}) WHERE dataflow NOT LIKE 'api/x%'",
)
def lineage_edges_three_hop(t):
    return L.lineage_edges(X.dataflows(t), legacy_three_hop=True)


@query(
    "tables_with_lineage",
    f"""WITH {X.EDGES},
    ends AS (SELECT src AS key, 'in' AS side, dataflow FROM edges
             WHERE NOT (src LIKE 'p%' AND src LIKE '%0')
             UNION SELECT dst, 'out', dataflow FROM edges)
    SELECT key, side, dataflow, 'Load ' || o_orderpriority AS title
    FROM ends LEFT JOIN orders ON dataflow = 'api/' || o_orderkey""",
)
def tables_with_lineage(t):
    titles = t.orders.select(
        F.concat(F.lit("api/"), F.col("o_orderkey").cast("string")).alias("dataflow"),
        F.concat(F.lit("Load "), "o_orderpriority").alias("title"),
    )
    return L.tables_with_lineage(X.dataflows(t), titles)


def _mapping(t):
    """Column mapping sheet: nation tables feed segment tables, one row per customer."""
    mapping = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("source_table"), F.col("c_mktsegment").alias("target_table")
    )
    segments = t.customer.where("c_mktsegment <> 'MACHINERY'").select("c_mktsegment").distinct()
    catalog = t.nation.where("n_regionkey <> 2").select(
        F.col("n_name").alias("name"), F.concat(F.lit("1.src."), F.lower("n_name")).alias("key")
    ).unionByName(
        segments.select(
            F.col("c_mktsegment").alias("name"),
            F.concat(F.lit("2.dst."), F.lower("c_mktsegment")).alias("key"),
        )
    )
    return L.lineage_from_mapping(mapping, catalog)


_PAIRS = """pairs AS (SELECT DISTINCT n_name, c_mktsegment, n_regionkey <> 2 AS src_known,
    c_mktsegment <> 'MACHINERY' AS dst_known, '1.src.' || lower(n_name) AS src,
    '2.dst.' || lower(c_mktsegment) AS dst FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query(
    "lineage_from_mapping",
    f"""WITH {_PAIRS} SELECT src, 'api/' || substr(sha256(src || '>' || dst), 1, 16) AS dataflow, dst,
      'Dataflow from ' || n_name || ' to ' || c_mktsegment AS description
    FROM pairs WHERE src_known AND dst_known""",
)
def lineage_from_mapping(t):
    return _mapping(t)[0]


@query(
    "lineage_unresolved",
    f"""WITH {_PAIRS} SELECT n_name AS src_name, c_mktsegment AS dst_name,
      CASE WHEN src_known THEN 'target' ELSE 'source' END AS missing
    FROM pairs WHERE NOT (src_known AND dst_known)""",
)
def lineage_unresolved(t):
    return _mapping(t)[1]


@query(
    "flagged_field_lineage",
    """SELECT 'table' AS kind, 'external:ext > dataflow:api/ext-' || substr(sha256('' || doc_id), 1, 16)
       || ' > column:' || doc_id AS path FROM labels WHERE toxic = 1""",
)
def flagged_field_lineage(t):
    paths = L.flagged_field_lineage(t.labels, "toxic", "doc_id", "ext", mark=1)
    hop = F.transform("path", lambda h: F.concat_ws(":", h[0]["otype"], h[0]["key"]))
    return paths.select(F.lit("table").alias("kind"), F.array_join(hop, " > ").alias("path"))


@query(
    "query_log",
    f"""WITH {X.LOG}
    SELECT event_id, user_name, ' ' AS default_databases, session_id,
           start_time AS session_start_time, start_time, query_string FROM log""",
)
def query_log(t):
    return G.query_log(X.audit(t)).drop("file_no")


@query(
    "stream_query_log",
    f"""WITH {X.LOG}
    SELECT event_id, user_name, ' ' AS default_databases, session_id, start_time AS session_start_time,
           start_time, query_string, CAST(substr(start_time, 1, 10) AS DATE) AS day FROM log""",
)
def stream_query_log_query(t):
    source, sink, checkpoint = (scratch_path(t.spark, n) for n in ("audit", "log", "stream"))
    audit = X.audit(t)
    audit.write.json(source)
    audit.write.mode("append").json(source)  # every file is delivered twice
    stream = stream_query_log(t.spark, source, X.AUDIT_SCHEMA, sink, checkpoint)
    stream.awaitTermination()
    return t.spark.read.parquet(sink).drop("event_ts", "event_key", "file_no", "batch")


# the statements of each text: comments and blank ones are left out
_DELETE = "'DELETE FROM mart.m' || user_id"
_WITH = f"""'INSERT INTO mart.m' || user_id || ' WITH w AS (SELECT * FROM ' || {X._A}
      || ') SELECT extract(year FROM d) FROM (SELECT id FROM ' || {X._B} || ' WHERE id IS DISTINCT FROM no.col) z, w'"""
_INSERT = f"""'INSERT INTO mart.m' || user_id || ' SELECT * FROM ' || {X._A} || ' p, ' || {X._B}
      || ' q ' || chr(10) || 'WHERE p.c = ''a;b from no.where'''"""
_STATEMENTS = f"""st AS (
  SELECT event_id, user_id, 0 AS statement_no, CASE event_id % 6 WHEN 4 THEN {_DELETE}
    WHEN 2 THEN {_INSERT} ELSE sql_text END AS statement FROM q
  UNION ALL SELECT event_id, user_id, 1, {_WITH} FROM q WHERE event_id % 6 = 4)"""


@query(
    "split_statements",
    f"WITH {X.QUERIES}, {_STATEMENTS} SELECT event_id, statement_no, statement FROM st",
)
def split_statements(t):
    return S.split_statements(X.queries(t), "sql_text").select("event_id", "statement_no", "statement")


_COPY_EDGE = "substr(sha256(q.sql_text), 1, 16)"
_SQL_EDGES = f"""moves AS (
  SELECT DISTINCT 'table' AS src_otype, unnest([{X._A}, {X._B}]) AS src, statement, 'mart.m' || user_id AS dst
    FROM st WHERE statement LIKE 'INSERT%'
  UNION ALL SELECT DISTINCT 'file', 's3://bucket/' || user_id || '/', statement, 'mart.m' || user_id
    FROM st WHERE statement LIKE 'COPY%')"""


@query(
    "sql_table_lineage",
    f"""WITH {X.QUERIES}, {_STATEMENTS}, {_SQL_EDGES}
    SELECT 'in' AS side, src_otype AS otype, src AS name, substr(sha256(statement), 1, 16) AS text_hash FROM moves
    UNION SELECT 'out', 'table', dst, substr(sha256(statement), 1, 16) FROM moves""",
)
def sql_table_lineage(t):
    statements = S.split_statements(X.queries(t), "sql_text").select("statement")
    # DuckDB has no SHA-224, so the dataflow is shown by the SHA-256 of its text
    text_hash = F.substring(F.sha2("content", 256), 1, 16)
    flows = S.sql_table_lineage(statements).withColumn("text_hash", text_hash)
    return _ends(L.lineage_edges(flows, carry=["text_hash"]), "text_hash")


def _ends(edges, *more):
    """What goes in and out of dataflows."""
    into = F.col("dst_otype") == "dataflow"
    return edges.select(
        F.when(into, F.lit("in")).otherwise(F.lit("out")).alias("side"),
        F.when(into, F.col("src_otype")).otherwise(F.col("dst_otype")).alias("otype"),
        F.when(into, F.col("src")).otherwise(F.col("dst")).alias("name"),
        *more,
    ).distinct()


@query(
    "resolve_tables",
    f"""WITH {X.QUERIES}, {_STATEMENTS}, {_SQL_EDGES}, {X.CATALOG_TABLES}
    SELECT DISTINCT src AS name, key FROM moves
    LEFT JOIN tab ON lower(split_part(src, '.', 1)) = "schema" AND lower(split_part(src, '.', 2)) = "table"
    WHERE src_otype = 'table' """,
)
def resolve_tables(t):
    statements = S.split_statements(X.queries(t), "sql_text").select("statement")
    edges = L.lineage_edges(S.sql_table_lineage(statements))
    names = edges.where("src_otype = 'table'").select(F.col("src").alias("name")).distinct()
    return S.resolve_tables(names, X.tables(t))


def _long_names(t):
    """Catalog with databases, and table names in texts of one to four parts, some quoted."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    database = F.concat(F.lit("db"), F.col("n_regionkey").cast("string"))
    table = F.concat(F.lit("t"), F.col("c_custkey").cast("string"))
    catalog = named.select(
        F.concat_ws(".", database, F.lower("n_name")).alias("schema"), table.alias("table"),
        F.concat_ws(".", database, F.lower("n_name"), table).alias("key"),
    )
    quoted = F.concat(F.lit('"'), F.col("n_name"), F.lit('"."'), F.upper(table), F.lit('"'))
    kind = F.col("c_custkey") % 8
    name = (
        F.when(kind == 0, F.upper(table))
        .when(kind == 1, F.concat_ws(".", "n_name", table))
        .when(kind == 2, quoted)
        .when(kind == 3, F.concat_ws(".", database, "n_name", table))
        .when(kind == 4, F.concat_ws(".", F.lit("`prod`"), database, F.concat(F.lit("["), "n_name", F.lit("]")), table))
        .when(kind == 5, F.concat_ws(".", database, table))
        .when(kind == 6, F.concat_ws(".", F.lit("db"), "n_name", table))
        .otherwise(F.concat(F.lit('"'), F.concat_ws(".", "n_name", table), F.lit('"')))
    )
    return named.select("c_custkey", name.alias("name")), catalog


@query(
    "resolve_long_names",
    """SELECT c_custkey, CASE WHEN c_custkey % 8 < 6
         THEN 'db' || n_regionkey || '.' || lower(n_name) || '.t' || c_custkey END AS key
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def resolve_long_names(t):
    return S.resolve_tables(*_long_names(t)).select("c_custkey", "key")


def _xml(t):
    """ETL project file per 50 events: tasks with SQL, of which every fifth lacks a name and every
    seventh has a second statement, and pipelines with query and target, each in a task of its own.
    """
    marks = (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;"), ("\n", "&#10;"))
    sql = F.col("sql_text")
    for char, entity in marks:
        sql = F.replace(sql, F.lit(char), F.lit(entity))
    key = F.col("event_id").cast("string")
    user = F.col("user_id").cast("string")
    name = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit(' DTS:ObjectName="Task &lt;'), key, F.lit('&gt;"'))).otherwise("")
    second = F.lit('<SQLTask:SqlTaskData SQLTask:SqlStatementSource="truncate table x > y"></SQLTask:SqlTaskData>')
    task = F.concat(
        F.lit('<DTS:Executable DTS:DTSID="{'), key, F.lit('}"'), name,
        F.lit('><DTS:ObjectData><SQLTask:SqlTaskData SQLTask:SqlStatementSource="'), sql, F.lit('"/>'),
        F.when(F.col("event_id") % 7 == 0, second).otherwise(""),
        F.lit('</DTS:ObjectData></DTS:Executable><!-- <DTS:Executable> --><DTS:Executable DTS:ObjectName="Pipe '), user,
        F.lit('"><DTS:ObjectData><pipeline><components><component><properties>'),
        F.lit('<property name="Query">select * from nation_'), user, F.lit(".t"), user,
        F.lit('</property><property name="TableName">mart.p'), user,
        F.lit("</property></properties></component></components></pipeline></DTS:ObjectData></DTS:Executable>"),
    )
    files = X.queries(t).groupBy(F.floor(F.col("event_id") / 50)).agg(F.collect_list(task).alias("tasks"))
    return files.select(
        F.concat(
            F.lit("<DTS:Executable>"), F.array_join("tasks", ""), F.lit("</DTS:Executable>")
        ).alias("content")
    )


@query(
    "xml_task_lineage",
    f"""WITH {X.QUERIES}, {_STATEMENTS}, {_SQL_EDGES}
    SELECT 'in' AS side, src_otype AS otype, src AS name FROM moves
    UNION SELECT 'out', 'table', dst FROM moves
    UNION SELECT 'in', 'table', 'nation_' || user_id || '.t' || user_id FROM events
    UNION SELECT 'out', 'table', 'mart.p' || user_id FROM events""",
)
def xml_task_lineage(t):
    tasks, pipelines = P.xml_task_lineage(_xml(t))
    flows = S.sql_table_lineage(S.split_statements(tasks.withColumnRenamed("statement", "s"), "s"))
    paths = flows.unionByName(S.pipeline_lineage(pipelines.select("query", "target").distinct()))
    return _ends(L.lineage_edges(paths))


_TASKS = f"""WITH {X.QUERIES}
    SELECT '{{' || event_id || '}}' AS task_id, CASE WHEN event_id % 5 <> 0 THEN 'Task <' || event_id || '>' END AS title,
      sha256(sql_text) AS text_hash FROM q
    UNION ALL SELECT '{{' || event_id || '}}', CASE WHEN event_id % 5 <> 0 THEN 'Task <' || event_id || '>' END,
      sha256('truncate table x > y') FROM q WHERE event_id % 7 = 0
    UNION ALL SELECT NULL, 'Pipe ' || user_id, sha256('select * from nation_' || user_id || '.t' || user_id || '>mart.p' || user_id) FROM q"""


def _named_tasks(files):
    tasks, pipelines = P.xml_task_lineage(files)
    whole = F.concat_ws(">", "query", "target")
    both = tasks.unionByName(pipelines.select("task_id", "title", whole.alias("statement")))
    return both.select("task_id", "title", F.sha2("statement", 256).alias("text_hash"))


@query("xml_tasks", _TASKS)
def xml_tasks(t):
    return _named_tasks(_xml(t))


@query("xml_tasks_in_pieces", _TASKS)
def xml_tasks_in_pieces(t):
    path = scratch_path(t.spark, "projects")
    _xml(t).write.text(path)
    return _named_tasks(P.task_pieces(t.spark, path))


@query(
    "execution_flatten",
    """SELECT conv_id AS session_id, conv_id * 10 + turn % 2 AS batch_id, conv_id * 1000 + turn AS event_id,
       CASE WHEN role = 'assistant' THEN turn END AS result_id,
       CASE WHEN role = 'assistant' THEN role END AS title, NULL AS url FROM conversations""",
)
def execution_flatten(t):
    result = F.when(
        F.col("role") == "assistant",
        F.struct(F.col("turn").alias("id"), F.col("role").alias("title"), F.lit(None).cast("string").alias("url")),
    )
    event = F.struct((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), result.alias("result"))
    # turns are cut in pieces of 64, so no array grows with a thread
    batches = t.conversations.groupBy(
        F.col("conv_id").alias("session_id"),
        (F.col("conv_id") * 10 + F.col("turn") % 2).alias("id"),
        F.floor(F.col("turn") / 64).alias("piece"),
    ).agg(F.collect_list(event).alias("events"))
    sessions = batches.select("session_id", F.array(F.struct("id", "events")).alias("batches"))
    return G.execution_flatten(sessions)


@query(
    "apply_result_schema",
    """SELECT p_partkey AS result_id, 0 AS row_no, p_name AS name, '' || p_size AS size, NULL AS note FROM part""",
)
def apply_result_schema(t):
    names = F.array(*[F.struct(F.lit(n).alias("name")) for n in ("name", "size", "note")])
    results = t.part.select(
        F.col("p_partkey").alias("result_id"),
        F.array(F.array("p_name", F.col("p_size").cast("string"))).alias("rows"),
        names.alias("data_schema"),
    )
    named = G.apply_result_schema(results, "rows", "data_schema")
    return named.select(
        "result_id", "row_no", *[F.col("row")[n].alias(n) for n in ("name", "size", "note")]
    )
