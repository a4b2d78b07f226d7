"""Catalog, tree, article, log and lineage tables derived from the given tables.

Each comes as a DataFrame and as SQL (a CTE) that gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.registry import Tables

# column types of the derived catalog, taken in turn
TYPES = [
    "varchar(20)", "BIGINT", "datetime", "numeric(12)", "string", "timestamp_ntz",
    "nvarchar(max)", "date", "boolean", "integer4", "varbinary(8)", "uniqueidentifier",
]
_TYPE_SQL = "[" + ", ".join(f"'{t}'" for t in TYPES) + "]"


def columns(t: Tables) -> DataFrame:
    """Regions as sources, nations as schemas, customers as tables, orders as columns."""
    types = F.array(*map(F.lit, TYPES))
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_regionkey").cast("bigint").alias("ds_id"),
            F.col("n_nationkey").cast("bigint").alias("schema_id"),
            F.lower("n_name").alias("schema_name"),
            F.col("c_custkey").alias("table_id"),
            F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table_name"),
            F.col("o_orderkey").alias("column_id"),
            F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("column_name"),
            F.element_at(types, (F.col("o_orderkey") % len(TYPES) + 1).cast("int")).alias("data_type"),
            (F.col("o_orderkey") % 5 != 0).alias("nullable"),
            F.col("o_orderpriority").alias("title"),
        )
    )


COLUMNS = f"""cat AS (
  SELECT CAST(n_regionkey AS BIGINT) AS ds_id, CAST(n_nationkey AS BIGINT) AS schema_id,
         lower(n_name) AS schema_name, c_custkey AS table_id, 't' || c_custkey AS table_name,
         o_orderkey AS column_id, 'o' || o_orderkey AS column_name,
         ({_TYPE_SQL})[o_orderkey % {len(TYPES)} + 1] AS data_type,
         o_orderkey % 5 <> 0 AS nullable, o_orderpriority AS title
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def tables(t: Tables) -> DataFrame:
    """Tables of the derived catalog with their key."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lower("n_name").alias("schema"),
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table"),
        F.col("c_custkey").alias("id"),
        F.concat_ws(
            ".", F.col("n_regionkey").cast("string"), F.lower("n_name"),
            F.concat(F.lit("t"), F.col("c_custkey").cast("string")),
        ).alias("key"),
    )


CATALOG_TABLES = """tab AS (
  SELECT lower(n_name) AS "schema", 't' || c_custkey AS "table", c_custkey AS id,
         n_regionkey || '.' || lower(n_name) || '.t' || c_custkey AS "key"
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def nodes(t: Tables, broken: bool = False) -> DataFrame:
    """Tree of BI objects: regions, nations and segments as folders, customers as reports.

    The broken variant lacks the nations of one region.
    """
    nation = t.nation.where("n_regionkey <> 2") if broken else t.nation
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    segment = F.concat(text("s", "c_nationkey"), F.lit(":"), "c_mktsegment")
    regions = t.region.select(
        F.lit("bi_folder").alias("otype"), text("r", "r_regionkey").alias("external_id"),
        F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_folder"),
    )
    nations = nation.select(
        F.lit("bi_folder"), text("n", "n_nationkey"), "n_name", text("r", "n_regionkey")
    )
    segments = t.customer.select(
        F.lit("bi_folder"), segment, "c_mktsegment", text("n", "c_nationkey")
    ).distinct()
    customers = t.customer.select(F.lit("bi_report"), text("c", "c_custkey"), "c_name", segment)
    return regions.union(nations).union(segments).union(customers)


def nodes_sql(broken: bool = False) -> str:
    where = "WHERE n_regionkey <> 2" if broken else ""
    return f"""nodes AS (
  SELECT 'bi_folder' AS otype, 'r' || r_regionkey AS external_id, r_name AS name,
         CAST(NULL AS VARCHAR) AS parent_folder FROM region
  UNION ALL SELECT 'bi_folder', 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM nation {where}
  UNION ALL SELECT DISTINCT 'bi_folder', 's' || c_nationkey || ':' || c_mktsegment, c_mktsegment,
         'n' || c_nationkey FROM customer
  UNION ALL SELECT 'bi_report', 'c' || c_custkey, c_name,
         's' || c_nationkey || ':' || c_mktsegment FROM customer)"""


# every node with the ids, names and levels from its top ancestor down
TRAILS = """trail AS (
  SELECT external_id, name, parent_folder, [external_id] AS ids, [name] AS names,
         parent_folder IS NULL AS ok
  FROM nodes WHERE parent_folder IS NULL
     OR parent_folder NOT IN (SELECT external_id FROM nodes)
  UNION ALL
  SELECT n.external_id, n.name, n.parent_folder, list_append(t.ids, n.external_id),
         list_append(t.names, n.name), t.ok
  FROM nodes n JOIN trail t ON n.parent_folder = t.external_id)"""


def articles(t: Tables) -> DataFrame:
    """An article per order with one reference, some of them to nothing, and a plain link."""
    otype = F.element_at(
        F.array(F.lit("article"), F.lit("query"), F.lit("table")),
        (F.col("o_orderkey") % 3 + 1).cast("int"),
    )
    ref = F.when(
        F.col("o_orderkey") % 3 == 2,
        F.concat(F.lower("n_name"), F.lit(".t"), F.col("o_custkey").cast("string"), F.lit(" (table)")),
    ).otherwise(F.col("n_name"))
    ref = F.when(F.col("o_orderkey") % 7 == 0, F.concat(ref, F.lit(" x"))).otherwise(ref)
    ref = F.when(
        (F.col("o_orderkey") % 21 == 8), F.concat(F.lit("no.such"), F.lit(" table"))
    ).otherwise(ref)
    key = F.col("o_orderkey").cast("string")
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("Order "), key).alias("title"),
            F.concat(
                F.lit("<p>See\n <a class=\"m\" data-oid=\""), F.col("o_custkey").cast("string"),
                F.lit("\" data-otype=\""), otype, F.lit("\" href=\"/old/"), key,
                F.lit("/\" title=\""), ref, F.lit("\">link &amp; <b>"), ref,
                F.lit("</b></a>, or <a href=\"/home\">home</a>; <a data-oid=\""), key,
                F.lit("\" data-otype=\"article\" href=\"/x/\">"), F.col("n_name"),
                F.lit("</a>  </p>"),
            ).alias("body"),
        )
    )


ARTICLES = """art0 AS (
  SELECT o_orderkey, o_custkey, n_name, ['article', 'query', 'table'][o_orderkey % 3 + 1] AS otype,
    CASE WHEN o_orderkey % 21 = 8 THEN 'no.such table' ELSE
      (CASE WHEN o_orderkey % 3 = 2 THEN lower(n_name) || '.t' || o_custkey || ' (table)' ELSE n_name END)
      || (CASE WHEN o_orderkey % 7 = 0 THEN ' x' ELSE '' END) END AS ref
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
art AS (
  SELECT o_orderkey AS id, 'Order ' || o_orderkey AS title,
    '<p>See' || chr(10) || ' <a class="m" data-oid="' || o_custkey || '" data-otype="' || otype
    || '" href="/old/' || o_orderkey || '/" title="' || ref || '">link &amp; <b>' || ref
    || '</b></a>, or <a href="/home">home</a>; <a data-oid="' || o_orderkey
    || '" data-otype="article" href="/x/">' || n_name || '</a>  </p>' AS body,
    o_orderkey, o_custkey, n_name, otype, ref
  FROM art0)"""


def reference_dims(t: Tables) -> dict[str, DataFrame]:
    """Targets of references: nations as articles (each twice) and queries, customers as tables."""
    nation = t.nation.select(F.col("n_name").alias("title"), F.col("n_nationkey").alias("n"))
    twice = nation.select("title", F.col("n").cast("bigint").alias("id")).unionByName(
        nation.select("title", (F.col("n") + 100).cast("bigint").alias("id"))
    )
    return {
        "article": twice,
        "query": twice,
        "table": tables(t).select(F.concat_ws(".", "schema", "table").alias("title"), "id"),
    }


# the id that a reference resolves to: first article, last query, table by name
REFERENCE_IDS = f"""{CATALOG_TABLES},
dims AS (
  SELECT 'article' AS otype, n_name AS title, CAST(n_nationkey AS BIGINT) AS id FROM nation
  UNION ALL SELECT 'query', n_name, CAST(n_nationkey + 100 AS BIGINT) FROM nation
  UNION ALL SELECT 'table', "schema" || '.' || "table", id FROM tab),
refs AS (
  SELECT a.*, d.id AS oid, f.id AS second_oid
  FROM art a
  LEFT JOIN dims d ON d.otype = a.otype
    AND d.title = CASE WHEN a.otype = 'table' THEN split_part(a.ref, ' ', 1) ELSE a.ref END
  LEFT JOIN dims f ON f.otype = 'article' AND f.title = a.n_name)"""

AUDIT_SCHEMA = (
    "file_no bigint, Records array<struct<eventID: string, eventName: string, errorCode: string, "
    "eventTime: string, userIdentity: struct<type: string, principalId: string, userName: string>, "
    "requestParameters: string, responseElements: string>>"
)


def _sql_text():
    """SQL text of an event, by its user and number."""
    u = F.col("user_id").cast("string")
    cust = F.col("user_id")
    a = F.concat(F.lit("nation_"), (cust % 25).cast("string"), F.lit(".t"), u)
    b = F.concat(F.lit("Nation_"), ((cust + 1) % 25).cast("string"), F.lit(".T"), (cust + 1).cast("string"))
    kind = F.col("event_id") % 6
    return (
        F.when(kind == 0, F.lit("SHOW TABLES IN main"))
        .when(kind == 1, F.concat(F.lit("SELECT * FROM "), a, F.lit(" x JOIN "), b, F.lit(" y ON x.id = y.id")))
        .when(kind == 2, F.concat(F.lit("INSERT INTO mart.m"), u, F.lit(" SELECT * FROM "), a, F.lit(" p, "), b, F.lit(" q -- from none.such\nWHERE p.c = 'a;b from no.where'")))
        .when(kind == 3, F.concat(F.lit("COPY mart.m"), u, F.lit(" FROM 's3://bucket/"), u, F.lit("/' CSV")))
        .when(kind == 4, F.concat(F.lit("/* two; parts */ DELETE FROM mart.m"), u, F.lit(";\nINSERT INTO mart.m"), u, F.lit(" WITH w AS (SELECT * FROM "), a, F.lit(") SELECT extract(year FROM d) FROM (SELECT id FROM "), b, F.lit(" WHERE id IS DISTINCT FROM no.col) z, w;")))
        .otherwise(F.concat(F.lit("select 1 from "), a))
    )


_A = "'nation_' || (user_id % 25) || '.t' || user_id"
_B = "'Nation_' || ((user_id + 1) % 25) || '.T' || (user_id + 1)"
SQL_TEXT = f"""CASE event_id % 6
    WHEN 0 THEN 'SHOW TABLES IN main'
    WHEN 1 THEN 'SELECT * FROM ' || {_A} || ' x JOIN ' || {_B} || ' y ON x.id = y.id'
    WHEN 2 THEN 'INSERT INTO mart.m' || user_id || ' SELECT * FROM ' || {_A} || ' p, ' || {_B}
      || ' q -- from none.such' || chr(10) || 'WHERE p.c = ''a;b from no.where'''
    WHEN 3 THEN 'COPY mart.m' || user_id || ' FROM ''s3://bucket/' || user_id || '/'' CSV'
    WHEN 4 THEN '/* two; parts */ DELETE FROM mart.m' || user_id || ';' || chr(10)
      || 'INSERT INTO mart.m' || user_id || ' WITH w AS (SELECT * FROM ' || {_A}
      || ') SELECT extract(year FROM d) FROM (SELECT id FROM ' || {_B} || ' WHERE id IS DISTINCT FROM no.col) z, w;'
    ELSE 'select 1 from ' || {_A} END"""


def queries(t: Tables) -> DataFrame:
    """Query texts: one per event."""
    return t.events.select("event_id", "user_id", "event_type", "ts", _sql_text().alias("sql_text"))


QUERIES = f"""q AS (SELECT event_id, user_id, event_type, ts, {SQL_TEXT} AS sql_text FROM events)"""


def audit(t: Tables, per_file: int = 50) -> DataFrame:
    """Audit files: records of ``per_file`` consecutive events in one array."""
    assumed = F.col("event_id") % 2 == 0
    user = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    record = F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("eventID"),
        F.when(F.col("event_type") == "signup", F.lit("GetObject"))
        .otherwise(F.lit("StartQueryExecution")).alias("eventName"),
        F.when(F.col("event_type") == "error", F.lit("AccessDenied")).alias("errorCode"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        F.struct(
            F.when(assumed, F.lit("AssumedRole")).otherwise(F.lit("IAMUser")).alias("type"),
            F.concat(F.lit("AROA:"), user).alias("principalId"),
            F.when(~assumed, user).alias("userName"),
        ).alias("userIdentity"),
        F.to_json(F.struct(F.col("sql_text").alias("queryString"))).alias("requestParameters"),
        F.concat(F.lit('{"queryExecutionId": "s'), F.col("event_id").cast("string"), F.lit('"}')).alias("responseElements"),
    )
    return (
        queries(t)
        .groupBy(F.floor(F.col("event_id") / per_file).alias("file_no"))
        .agg(F.collect_list(record).alias("Records"))
    )


# the rows that the query log keeps
LOG = f"""{QUERIES},
log AS (
  SELECT 'e' || event_id AS event_id, 'user' || user_id AS user_name, 's' || event_id AS session_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS start_time, sql_text AS query_string
  FROM q WHERE event_type NOT IN ('signup', 'error') AND sql_text NOT LIKE 'SHOW%')"""


def threads(t: Tables, per_row: int = 64) -> DataFrame:
    """Threads as arrays of posts; a long one takes a row for every ``per_row`` turns."""
    post = F.struct(
        (F.col("conv_id") * F.lit(1 << 32) + F.col("turn")).alias("no"),
        "turn", "role", F.col("text").alias("com"),
    )
    return (
        t.conversations.groupBy("conv_id", F.floor(F.col("turn") / per_row).alias("piece"))
        .agg(F.sort_array(F.collect_list(post)).alias("posts"))
    )


def dataflows(t: Tables) -> DataFrame:
    """Lineage path per order line: part -> order -> supplier; every fifth order has five hops."""
    def end(otype: str, prefix: str, c: str, temp=F.lit(False)):
        return F.array(
            F.struct(
                F.lit(otype).alias("otype"),
                F.concat(F.lit(prefix), F.col(c).cast("string")).alias("key"),
                temp.alias("is_temp"),
            )
        )

    is_temp = F.col("l_partkey") % 10 == 0
    three = F.array(
        end("table", "p", "l_partkey", is_temp),
        end("dataflow", "api/", "l_orderkey"),
        end("table", "s", "l_suppkey"),
    )
    longer = F.concat(three, F.array(end("dataflow", "api/x", "l_orderkey"), end("table", "o", "l_orderkey")))
    return t.lineitem.select(
        F.when(F.col("l_orderkey") % 5 == 0, longer).otherwise(three).alias("path")
    )


EDGES = """edges AS (
  SELECT DISTINCT 'table' AS src_otype, 'p' || l_partkey AS src, 'api/' || l_orderkey AS dataflow,
         'table' AS dst_otype, 's' || l_suppkey AS dst FROM lineitem
  UNION
  SELECT DISTINCT 'table', 's' || l_suppkey, 'api/x' || l_orderkey, 'table', 'o' || l_orderkey
  FROM lineitem WHERE l_orderkey % 5 = 0)"""


def wide_attrs(t: Tables) -> DataFrame:
    """Field values of customers as one wide row each."""
    text = lambda c: F.col(c).cast("string")
    return t.customer.select(
        F.lit("table").alias("otype"),
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("Segment"),
        F.concat_ws(";", F.concat(F.lit("gold "), text("c_nationkey")), F.lit("silver")).alias("tier"),
        F.concat_ws(";", F.concat(F.lit("n"), text("c_nationkey")), F.concat(F.lit("m"), text("c_custkey"))).alias("owners:user"),
        F.concat(F.lit("g"), text("c_nationkey")).alias("owners:groupprofile"),
        F.lit("x").alias("owners:robot"),
        F.lit("ignored").alias("no such field"),
    )


FIELDS = [
    (1, "segment", "PICKER", None, None),
    (2, "Tier", "MULTI_PICKER", ["gold", "silver", "bronze"], None),
    (3, "Owners", "OBJECT_SET", None, ["user", "groupprofile"]),
    (9, "tier", "PICKER", None, None),
]
FIELD_SCHEMA = (
    "field_id int, name string, field_type string, options array<string>, "
    "allowed_otypes array<string>"
)
