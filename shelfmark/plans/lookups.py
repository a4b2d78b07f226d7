"""Registered queries: joins and lookups."""

from pyspark.sql import functions as F

from shelfmark.operators import hierarchy as H
from shelfmark.operators import lookups as L
from shelfmark.operators import sqltext
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query


@query(
    "left_join_attrs",
    """SELECT 'doc' AS otype, doc_id AS id, lang, quality, toxic
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def left_join_attrs(t):
    docs = t.documents.select(F.lit("doc").alias("otype"), F.col("doc_id").alias("id"), "lang")
    attrs = t.labels.select(F.lit("doc").alias("otype"), F.col("doc_id").alias("id"), "quality", "toxic")
    return L.left_join_attrs(docs, attrs)


@query(
    "catalog_export",
    """SELECT CAST(r_regionkey AS BIGINT) AS ds_id, r_name AS ds_title, 'x' AS ds_type,
       c_custkey AS schema_id, c_name AS schema_name, o_orderkey AS table_id,
       o_orderstatus AS table_name, l_linenumber AS position, l_partkey AS attribute_id
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN region ON c_nationkey % 5 = r_regionkey
       WHERE r_regionkey <> 3 AND c_mktsegment <> 'MACHINERY' AND o_orderstatus <> 'P'
         AND l_returnflag <> 'N'""",
)
def catalog_export(t):
    ds = t.region.selectExpr(
        "cast(r_regionkey as bigint) as ds_id", "r_name as ds_title", "'x' as ds_type",
        "r_regionkey = 3 as deleted",
    )
    schema = t.customer.selectExpr(
        "c_custkey as schema_id", "cast(c_nationkey % 5 as bigint) as ds_id", "c_name as schema_name",
        "c_mktsegment = 'MACHINERY' as excluded",
    )
    table = t.orders.selectExpr(
        "o_orderkey as table_id", "o_orderstatus as table_name", "o_custkey as schema_id",
        "o_orderstatus = 'P' as excluded",
    )
    attribute = t.lineitem.selectExpr(
        "l_orderkey as table_id", "l_linenumber as position", "l_partkey as attribute_id",
        "l_returnflag = 'N' as excluded",
    )
    return L.catalog_export(ds, schema, table, attribute)


@query(
    "semi_join",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def semi_join(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return L.semi_join(t.orders, lines, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query(
    "new_only",
    """SELECT c_custkey, upper(c_name) AS title FROM customer
       WHERE lower(c_name) NOT IN (SELECT 'customer#' || lpad('' || o_custkey, 9, '0') FROM orders
                                   WHERE o_orderpriority = '1-URGENT')""",
)
def new_only(t):
    customers = t.customer.select("c_custkey", F.upper("c_name").alias("title"))
    existing = t.orders.where("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("title")
    ).distinct()
    return L.new_only(customers, existing, "title", ignore_case=True)


@query(
    "orphans",
    f"""WITH RECURSIVE {X.nodes_sql(broken=True)},
    missing AS (SELECT * FROM nodes WHERE parent_folder IS NOT NULL
                AND parent_folder NOT IN (SELECT external_id FROM nodes)),
    below AS (SELECT * FROM nodes WHERE parent_folder IN (SELECT external_id FROM missing)
              UNION ALL SELECT n.* FROM nodes n JOIN below b ON n.parent_folder = b.external_id)
    SELECT otype, external_id, name, parent_folder, 'parent missing' AS reason FROM missing
    UNION ALL SELECT otype, external_id, name, parent_folder, 'parent left out' FROM below""",
)
def orphans(t):
    return H.orphans(X.nodes(t, broken=True), "external_id", "parent_folder")


@query(
    "unique_lookup",
    """SELECT q.p_partkey, q.name, u.found FROM
      (SELECT p_partkey, p_name || '/' || p_brand || '/' || p_size AS name FROM part) q
    LEFT JOIN (SELECT p_name || '/' || p_brand || '/' || p_size AS name, min(p_partkey) AS found
               FROM part GROUP BY 1 HAVING count(*) = 1) u USING (name)""",
)
def unique_lookup(t):
    named = t.part.select(
        "p_partkey",
        F.concat_ws("/", "p_name", "p_brand", F.col("p_size").cast("string")).alias("name"),
    )
    dim = named.select("name", F.col("p_partkey").alias("found"))
    return L.unique_lookup(named, dim, "name", "found")


@query(
    "policy_lookup",
    """SELECT p.p_partkey, p.p_name, f.first_key, f.last_key FROM part p
       JOIN (SELECT p_name, min(p_partkey) AS first_key, max(p_partkey) AS last_key
             FROM part GROUP BY p_name) f USING (p_name)""",
)
def policy_lookup(t):
    parts = t.part.select("p_partkey", "p_name")
    for pick in ("first", "last"):
        dim = t.part.select("p_name", F.col("p_partkey").alias(f"{pick}_key"))
        parts = L.policy_lookup(parts, dim, "p_name", f"{pick}_key", f"{pick}_key", pick)
    return parts


@query(
    "id_remap",
    """SELECT s_suppkey AS row_id, s_suppkey AS old_id, s_name AS ext,
       CASE WHEN s_acctbal >= 1000 THEN s_suppkey + 5000 END AS new_id FROM supplier""",
)
def id_remap(t):
    rows = t.supplier.selectExpr("s_suppkey as row_id", "s_suppkey as old_id")
    src = t.supplier.selectExpr("s_suppkey as old_id", "s_name as ext")
    dst = t.supplier.selectExpr("s_name as ext", "s_suppkey + 5000 as new_id", "s_acctbal")
    doubled = dst.unionByName(dst.where("s_acctbal < 1000"))
    return L.id_remap(rows, src, doubled, "ext")


@query(
    "offset_ids",
    """SELECT s_suppkey, 1000 + row_number() OVER (ORDER BY s_name DESC, s_suppkey) AS new_id
       FROM supplier""",
)
def offset_ids(t):
    return L.offset_ids(t.supplier.select("s_suppkey", "s_name"), [F.desc("s_name"), "s_suppkey"], 1000).drop("s_name")


@query(
    "mapping_join",
    """SELECT c_custkey, c_mktsegment AS template,
       CASE c_mktsegment WHEN 'BUILDING' THEN 47 ELSE 48 END AS template_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN 3 ELSE 4 END AS glossary_id
       FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')""",
)
def mapping_join(t):
    rows = t.customer.select("c_custkey", F.col("c_mktsegment").alias("template"))
    mapping = {"BUILDING": (47, 3), "FURNITURE": (48, 4)}
    return L.mapping_join(rows, mapping, "template", ["template_id", "glossary_id"])


@query(
    "bidirectional_lookup",
    """SELECT c_custkey, c_custkey % 30 AS n_nationkey, coalesce(n_name, 'unknown') AS n_name,
       CAST(c_custkey % 25 AS INT) AS back
       FROM customer LEFT JOIN nation ON n_nationkey = c_custkey % 30""",
)
def bidirectional_lookup(t):
    forward, backward = L.bidirectional_lookup(t.nation, "n_nationkey", "n_name")
    rows = t.customer.select(
        "c_custkey",
        (F.col("c_custkey") % 30).alias("n_nationkey"),
        F.concat(F.lit("NATION_"), (F.col("c_custkey") % 25).cast("string")).alias("asked"),
    )
    named = L.look_up_name(rows, forward, "n_nationkey", "n_name")
    back = backward.select(F.col("n_name").alias("asked"), F.col("n_nationkey").alias("back"))
    return L.lookup_join(named, back, "asked").drop("asked")


@query(
    "membership_resolve",
    """WITH m AS (SELECT DISTINCT o_orderpriority AS g, o_custkey, c_custkey AS id
                  FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0),
    k AS (SELECT g, id, row_number() OVER (PARTITION BY g ORDER BY id) AS rn FROM m WHERE id IS NOT NULL),
    parts AS (SELECT g, (rn - 1) // 50 AS part, string_agg(id, ',' ORDER BY rn) AS user_ids FROM k GROUP BY 1, 2),
    lost AS (SELECT g, count(*) FILTER (id IS NULL) AS unknown FROM m GROUP BY g)
    SELECT g AS "group", coalesce(part, 0) AS part, user_ids, unknown FROM lost LEFT JOIN parts USING (g)""",
)
def membership_resolve(t):
    name = lambda c: F.concat(F.lit("user"), F.col(c).cast("string"))
    members = t.orders.select(F.col("o_orderpriority").alias("group"), name("o_custkey").alias("user"))
    users = t.customer.where("c_acctbal >= 0").select(
        name("c_custkey").alias("user"), F.col("c_custkey").alias("user_id")
    )
    resolved = L.membership_resolve(members, users, size=50)
    return resolved.withColumn("user_ids", F.array_join("user_ids", ","))


@query(
    "merge_on_key",
    f"""WITH {X.COLUMNS}
    SELECT ds_id || '.' || schema_name || '.' || table_name || '.' || column_name AS path, title,
           column_id FROM cat""",
)
def merge_on_key(t):
    cat = X.columns(t)
    path = F.concat_ws(".", F.col("ds_id").cast("string"), "schema_name", "table_name", "column_name")
    logical = cat.select(path.alias("path"), "title")
    physical = cat.select(path.alias("path"), "column_id")
    return L.merge_on_key(logical, physical)


@query(
    "array_lookup",
    """SELECT o_orderkey, string_agg(p_name, '|' ORDER BY n) AS titles
       FROM (SELECT o_orderkey, unnest([o_orderkey % 300, o_custkey % 300, 7]) AS p_partkey,
                    generate_subscripts([1, 2, 3], 1) AS n FROM orders)
       JOIN part USING (p_partkey) GROUP BY 1""",
)
def array_lookup(t):
    rows = t.orders.select(
        "o_orderkey",
        F.array(F.col("o_orderkey") % 300, F.col("o_custkey") % 300, F.lit(7).cast("bigint")).alias("ids"),
    )
    titled = L.array_lookup(rows, "o_orderkey", "ids", t.part, "p_partkey", "p_name")
    return titled.select("o_orderkey", F.array_join("p_name", "|").alias("titles"))


@query(
    "mention_resolve",
    """WITH base AS (
      SELECT event_id, user_id, c_custkey IS NOT NULL AS known
      FROM events LEFT JOIN customer ON c_custkey = user_id AND c_mktsegment <> 'MACHINERY')
    SELECT event_id, 'Uses ' || (CASE WHEN known THEN '<p><a data-oid="' || user_id
        || '" data-otype="attribute" href="/attribute/' || user_id || '/">T' || user_id
        || '.NAME</a></p>' ELSE 'T' || user_id || '.NAME' END) || ', not NO.SUCH or a.b.' AS note
    FROM base""",
)
def mention_resolve(t):
    mention = F.concat(F.lit("T"), F.col("user_id").cast("string"), F.lit(".NAME"))
    notes = t.events.select(
        "event_id", F.concat(F.lit("Uses "), mention, F.lit(", not NO.SUCH or a.b.")).alias("note")
    )
    columns = t.customer.where("c_mktsegment <> 'MACHINERY'").select(
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table"),
        F.lit("name").alias("column"),
        F.col("c_custkey").alias("id"),
    )
    return sqltext.mention_resolve(notes, "event_id", "note", columns)


@query(
    "text_dictionary_match",
    rf"""WITH {X.QUERIES}, {X.CATALOG_TABLES},
    r AS (SELECT event_id, unnest(regexp_extract_all(sql_text, '(?i)\b(from|join)\W+(\w+)[.](\w+)', 1)) AS statement,
                 unnest(regexp_extract_all(sql_text, '(?i)\b(from|join)\W+(\w+)[.](\w+)', 2)) AS s,
                 unnest(regexp_extract_all(sql_text, '(?i)\b(from|join)\W+(\w+)[.](\w+)', 3)) AS tb
          FROM q)
    SELECT event_id, lower(statement) AS statement, key FROM r
    JOIN tab ON lower(s) = "schema" AND lower(tb) = "table" """,
)
def text_dictionary_match(t):
    found = sqltext.text_dictionary_match(X.queries(t), "event_id", "sql_text", X.tables(t))
    return found.select("event_id", "statement", "key")


@query(
    "text_dictionary_long_names",
    f"""WITH {X.CATALOG_TABLES}
    SELECT id, 'from' AS statement, "schema", "table", key FROM tab
    UNION ALL SELECT id, 'join', 'prod.' || "schema", "table", key FROM tab""",
)
def text_dictionary_long_names(t):
    tables = X.tables(t)
    name = lambda *parts: F.concat_ws(".", *parts)
    quoted = lambda c: F.concat(F.lit('"'), F.upper(c), F.lit('"'))
    text = F.concat(
        F.lit("select extract(day from d) FROM "), name(quoted("schema"), quoted("table")),
        F.lit(" a join ("), name(F.lit("[prod]"), "schema", F.concat(F.lit("`"), "table", F.lit("`"))), F.lit(" b) join no.such"),
    )
    log = tables.select("id", text.alias("text"))
    return sqltext.text_dictionary_match(log, "id", "text", tables).drop("pos")
