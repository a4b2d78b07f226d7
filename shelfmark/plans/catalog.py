"""Registered queries: catalogs, attributes, schemas, profiles and quality."""

from pyspark.sql import functions as F

from shelfmark.operators import attributes as A
from shelfmark.operators import catalog as C
from shelfmark.operators import quality as Q
from shelfmark.operators import schematree as S
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query

_WITH = f"WITH {X.COLUMNS}"


@query(
    "catalog_from_sheet",
    f"""{_WITH}, s AS (SELECT CASE WHEN title = '5-LOW' THEN NULL ELSE schema_name END AS sc, table_name AS tb,
                              title AS col, data_type AS ty, column_id FROM cat)
    SELECT DISTINCT '77.' || sc AS key, NULL AS table_type, NULL AS column_type FROM s WHERE sc IS NOT NULL
    UNION ALL SELECT DISTINCT '77.' || sc || '.' || tb, 'TABLE', NULL FROM s WHERE sc IS NOT NULL
    UNION ALL SELECT '77.' || sc || '.' || tb || '.' || col, NULL, arg_min(ty, column_id)
      FROM s WHERE sc IS NOT NULL GROUP BY sc, tb, col""",
)
def catalog_from_sheet(t):
    sheet = X.columns(t).select(
        F.when(F.col("title") != "5-LOW", F.col("schema_name")).alias("sc"),
        "table_name", "title", "data_type", "column_id",
    )
    return C.catalog_from_sheet(sheet, "sc", "table_name", "title", "data_type", "77", "column_id")


@query(
    "data_dictionary",
    f"""{_WITH}
    SELECT '' || r_regionkey AS key, r_name AS title, 'source' AS description, NULL AS schema_id,
           NULL AS table_id, NULL AS column_id, NULL AS data_type FROM region
    UNION ALL SELECT n_regionkey || '.' || lower(n_name), n_name, 'schema', '' || n_nationkey, NULL, NULL, NULL FROM nation
    UNION ALL SELECT n_regionkey || '.' || lower(n_name) || '.t' || c_custkey, c_name, 'table',
           '' || n_nationkey, '' || c_custkey, NULL, NULL FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT ds_id || '.' || schema_name || '.' || table_name || '.' || column_name, title, 'column',
           '' || schema_id, '' || table_id, '' || column_id, data_type FROM cat""",
)
def data_dictionary(t):
    ds = t.region.selectExpr("r_regionkey as ds_id", "r_name as title", "'source' as description")
    schemas = t.nation.selectExpr(
        "n_regionkey as ds_id", "lower(n_name) as name", "n_name as title", "'schema' as description",
        "n_nationkey as id",
    )
    tables = t.customer.join(t.nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "n_regionkey as ds_id", "lower(n_name) as schema_name", "concat('t', c_custkey) as name",
        "c_name as title", "'table' as description", "n_nationkey as schema_id", "c_custkey as id",
    )
    columns = X.columns(t).selectExpr(
        "ds_id", "concat(schema_name, '.', table_name) as table_name", "column_name as name", "title",
        "'column' as description", "schema_id", "table_id", "column_id as id", "data_type",
    )
    return C.data_dictionary(ds, schemas, tables, columns)


@query("rekey_catalog", f'WITH {X.CATALOG_TABLES} SELECT \'42.\' || "schema" || \'.\' || "table" AS key, id FROM tab')
def rekey_catalog(t):
    return C.rekey_catalog(X.tables(t).select("key", "id"), "key", 42)


def _dump(t, kind):
    """Adapter dump lines of the derived catalog."""
    cat = X.columns(t)
    named = lambda c: F.struct(F.col(c).alias("original_"))
    parts = [F.struct(F.concat(F.lit("DB"), F.col("ds_id").cast("string")).alias("original_")).alias("databaseCatalog_")]
    if kind == "schema":
        parts.append(named("schema_upper").alias("name_"))
    else:
        parts.append(named("schema_upper").alias("schema_"))
    if kind == "table":
        parts.append(named("table_name").alias("name_"))
    if kind == "column":
        parts += [named("table_name").alias("table_"), named("dotted").alias("name_")]
    code = F.struct((F.col("table_id") % 4 if kind == "table" else F.col("column_id") % 9).alias("normalized_"))
    cols = [F.struct(*parts).alias("id_")]
    if kind != "schema":
        cols.append(code.alias("type_"))
    cat = cat.withColumn("schema_upper", F.upper("schema_name")).withColumn(
        "dotted", F.concat(F.lit("C."), "column_name")
    )
    return cat.select(*cols, F.lit("left out").alias("comment")).distinct()


def _normalized(t, kind):
    codes = {"table": C.TABLE_TYPES, "column": C.COLUMN_TYPES}.get(kind, {})
    blacklist = ["db1.nation_1", "db2.nation_2"]
    return C.normalize_dump(_dump(t, kind), codes, blacklist, True, kind)


_CODES = "CASE table_id % 4 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 3 THEN 'SYNONYM' END"
_COLUMN_CODES = "CASE column_id % 9 " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in C.COLUMN_TYPES.items()
) + " END"
_KEPT = """kept AS (SELECT *, 'db' || ds_id || '.' || schema_name AS ls FROM cat
        WHERE 'db' || ds_id || '.' || schema_name NOT IN ('db1.nation_1', 'db2.nation_2'))"""


@query(
    "normalize_dump",
    f"""{_WITH}, {_KEPT}
    SELECT DISTINCT ls AS lower_schema, table_name AS name, {_CODES} AS type FROM kept""",
)
def normalize_dump(t):
    return _normalized(t, "table").select(
        "lower_schema", F.col("id.name.original").alias("name"), F.col("type.normalized").alias("type")
    )


@query(
    "catalog_amalgam",
    f"""{_WITH}, {_KEPT}
    SELECT DISTINCT ls AS key, '' AS table_type, '' AS column_type FROM kept
    UNION ALL SELECT DISTINCT ls || '.' || table_name, coalesce({_CODES}, ''), '' FROM kept
    UNION ALL SELECT ls || '.' || table_name || '.c_' || column_name, '', coalesce({_COLUMN_CODES}, '') FROM kept""",
)
def catalog_amalgam(t):
    return C.catalog_amalgam(*[_normalized(t, kind) for kind in ("schema", "table", "column")])


_CASE = "CASE " + " ".join(
    f"WHEN regexp_matches(data_type, '(?i){p}') THEN '{v}'" for p, v in C.TYPE_RULES
) + " ELSE data_type END"
_ANY = " OR ".join(f"regexp_matches(data_type, '(?i){p}')" for p, _ in C.TYPE_RULES)


@query(
    "map_types",
    f"""{_WITH} SELECT data_type, count(*) AS n, {_CASE} AS mapped_type, {_ANY} AS replaced
    FROM cat GROUP BY data_type""",
)
def map_types(t):
    _, stats = C.map_types(X.columns(t), "data_type")
    return stats


@query(
    "table_ddl",
    f"""{_WITH}, c AS (SELECT *, {_CASE} AS mapped, row_number() OVER
          (PARTITION BY schema_name, table_name ORDER BY column_id, column_name) AS rn FROM cat),
    d AS (SELECT schema_name, table_name, CAST((rn - 1) // 6 AS INT) AS part,
            list('"' || column_name || '" ' || mapped || (CASE WHEN nullable THEN '' ELSE ' NOT NULL' END)
                 ORDER BY rn) AS defs FROM c GROUP BY 1, 2, 3)
    SELECT schema_name, table_name, part, CASE WHEN part = 0
      THEN 'CREATE TABLE IF NOT EXISTS "' || schema_name || '"."' || table_name || '"(' || array_to_string(defs, ',') || ')'
      ELSE 'ALTER TABLE "' || schema_name || '"."' || table_name || '" ADD COLUMN ' || array_to_string(defs, ', ADD COLUMN ')
      END AS ddl FROM d""",
)
def table_ddl(t):
    mapped, _ = C.map_types(X.columns(t), "data_type")
    cols = mapped.select(
        "schema_name", "table_name", F.col("column_name").alias("attribute_name"),
        F.col("column_id").alias("position"), "mapped_type", "nullable",
    )
    return C.table_ddl(cols, size=6)


def _values(t):
    """Long field values of customers: a picker set twice, and an object set of two types."""
    base = t.customer.select(F.lit("table").alias("otype"), F.col("c_custkey").alias("id"), "*")
    rows = lambda field, order, value, kind: base.select(
        "otype", "id", F.lit(field).alias("field_id"), F.lit(order).alias("ord"),
        value.alias("value"), F.lit(kind).alias("value_otype"),
    )
    nation = F.col("c_nationkey").cast("string")
    return (
        rows(1, 1, F.lower("c_mktsegment"), None)
        .unionByName(rows(1, 2, F.col("c_mktsegment"), None))
        .unionByName(rows(3, 1, F.concat(F.lit("n"), nation), "user"))
        .unionByName(rows(3, 2, F.concat(F.lit("a"), nation), "user"))
        .unionByName(rows(3, 3, F.concat(F.lit("g"), nation), "groupprofile"))
    )


def _fields(t):
    return t.spark.createDataFrame(X.FIELDS, X.FIELD_SCHEMA)


@query(
    "pivot_attrs",
    """SELECT 'table' AS otype, c_custkey AS id, 0 AS part, c_mktsegment AS segment,
       'n' || c_nationkey || ';a' || c_nationkey AS "owners:user",
       'g' || c_nationkey AS "owners:groupprofile" FROM customer""",
)
def pivot_attrs(t):
    known = ["segment", "owners:user", "owners:groupprofile"]
    return A.pivot_attrs(_values(t), _fields(t).select("field_id", "name", "field_type"), known)


@query(
    "unpivot_attrs",
    """SELECT 'table' AS otype, c_custkey AS id, 1 AS field_id, ':' || c_mktsegment AS items
       FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL SELECT 'table', c_custkey, 2, ':gold,:silver' FROM customer
    UNION ALL SELECT 'table', c_custkey, 3, 'user:n' || c_nationkey || ',user:m' || c_custkey
       || ',groupprofile:g' || c_nationkey FROM customer""",
)
def unpivot_attrs(t):
    long = A.unpivot_attrs(X.wide_attrs(t), _fields(t))
    item = F.transform(
        "values", lambda v: F.concat(F.coalesce(v["otype"], F.lit("")), F.lit(":"), v["value"])
    )
    return long.select("otype", "id", "field_id", F.array_join(item, ",").alias("items"))


def _objects(t):
    """Objects that field values name: all nations as users, every other customer, most groups."""
    row = lambda otype, name, oid: (F.lit(otype).alias("otype"), name.alias("name"), oid.cast("bigint").alias("oid"))
    nation, customer = F.col("n_nationkey"), F.col("c_custkey")
    users = t.nation.select(*row("user", F.concat(F.lit("N"), nation.cast("string")), nation + 100))
    more = t.customer.where("c_custkey % 2 = 0").select(
        *row("user", F.concat(F.lit("m"), customer.cast("string")), customer + 1000)
    )
    groups = t.nation.where("n_nationkey <> 3").select(
        *row("groupprofile", F.concat(F.lit("g"), nation.cast("string")), nation)
    )
    return users.unionByName(more).unionByName(groups).unionByName(more.withColumn("oid", F.col("oid") + 1))


_ITEMS = """SELECT c_custkey AS id, 'user' AS o, 'n' || c_nationkey AS v, c_nationkey + 100 AS oid, 1 AS p FROM customer
    UNION ALL SELECT c_custkey, 'user', 'm' || c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 1000 END, 2 FROM customer
    UNION ALL SELECT c_custkey, 'groupprofile', 'g' || c_nationkey, CASE WHEN c_nationkey <> 3 THEN c_nationkey END, 3 FROM customer"""


@query(
    "resolve_object_sets",
    f"""SELECT 'table' AS otype, c_custkey AS id, 1 AS field_id, ':' || c_mktsegment AS items
       FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL SELECT 'table', c_custkey, 2, ':gold,:silver' FROM customer
    UNION ALL SELECT 'table', id, 3, string_agg(o || ':' || oid, ',' ORDER BY p) FROM ({_ITEMS})
       WHERE oid IS NOT NULL GROUP BY id""",
)
def resolve_object_sets(t):
    found, _ = A.resolve_object_sets(A.unpivot_attrs(X.wide_attrs(t), _fields(t)), _objects(t))
    item = F.transform(
        "values",
        lambda v: F.concat(
            F.coalesce(v["otype"], F.lit("")), F.lit(":"), F.coalesce(v["oid"].cast("string"), v["value"])
        ),
    )
    return found.select("otype", "id", "field_id", F.array_join(item, ",").alias("items"))


@query(
    "unresolved_items",
    f"SELECT 'table' AS otype, id, 3 AS field_id, o AS value_otype, v AS value FROM ({_ITEMS}) WHERE oid IS NULL",
)
def unresolved_items(t):
    _, lost = A.resolve_object_sets(A.unpivot_attrs(X.wide_attrs(t), _fields(t)), _objects(t))
    return lost


@query(
    "explode_tags",
    """SELECT c_custkey, c_mktsegment AS tag FROM customer
       UNION SELECT c_custkey, '' || c_nationkey FROM customer""",
)
def explode_tags(t):
    tags = F.concat_ws(";", "c_mktsegment", F.concat(F.col("c_nationkey").cast("string"), F.lit(";;")))
    return A.explode_tags(t.customer.withColumn("tags", tags), ["c_custkey"], "tags")


_PROFILED = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY 2"
    for c in _PROFILED
)
_GATED = f"""counts AS ({_LONG}),
    gated AS (SELECT * FROM counts WHERE col IN
      (SELECT col FROM counts GROUP BY col HAVING count(*) > 20 AND count(*) <= 120))"""


@query(
    "value_frequency",
    f"""WITH {_GATED}
    SELECT col, value, n, rank FROM (SELECT *, row_number() OVER
      (PARTITION BY col ORDER BY n DESC, value) AS rank FROM gated) WHERE rank <= 10""",
)
def value_frequency(t):
    return Q.value_frequency(t.part, _PROFILED)


@query(
    "picker_fields",
    f"""WITH {_GATED}
    SELECT col, substr('DTV ' || col, 1, 25) AS name, 'PICKER' AS field_type,
      string_agg(value, '|' ORDER BY value) AS options FROM gated GROUP BY col""",
)
def picker_fields(t):
    pickers = A.picker_fields(t.part, _PROFILED, prefix="DTV ")
    return pickers.withColumn("options", F.array_join("options", "|"))


_CUSTOMER = {"c_name": "c_name", "c_mktsegment": "c_mktsegment", "c_nationkey": "CAST(c_nationkey AS VARCHAR)",
             "c_custkey": "CAST(c_custkey AS VARCHAR)", "c_acctbal": "CAST(c_acctbal AS VARCHAR)",
             "rich": "CASE WHEN c_acctbal > 9500 THEN c_name END"}


def _profiles(table, columns):
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS col, CAST(coalesce(sum(n), 0) AS BIGINT) AS filled, count(*) AS "distinct",
            coalesce(max(n), 0) AS largest, coalesce(max(n), 0) > 5
            OR coalesce(sum(n), 0) > 0.25 * (SELECT count(*) FROM {table}) AS interesting
            FROM (SELECT {sql} AS v, count(*) AS n FROM {table} WHERE {sql} IS NOT NULL GROUP BY 1)"""
        for name, sql in columns.items()
    )


_DOCUMENTS = {c: c for c in ("text", "lang", "source")} | {"n_chars": "CAST(n_chars AS VARCHAR)"}


@query("profile_texts", _profiles("documents", _DOCUMENTS))
def profile_texts(t):
    return Q.profile_columns(t.documents, list(_DOCUMENTS))


@query("profile_columns", _profiles("customer", _CUSTOMER))
def profile_columns(t):
    rich = F.when(F.col("c_acctbal") > 9500, F.col("c_name"))
    return Q.profile_columns(t.customer.withColumn("rich", rich))


_RULES = [
    ("r1", "l_quantity", "l_quantity > 0"),
    ("r2", "l_discount", "l_discount < 0.1"),
    ("r3", "l_shipdate", "l_shipdate >= timestamp '1996-01-01'"),
    ("r4", "l_comment", "l_comment is not null"),
]


@query(
    "dq_evaluate",
    " UNION ALL ".join(
        f"""SELECT '{k}' AS field_key, '1.main.lineitem.{c}' AS object_key, 'ATTRIBUTE' AS object_type,
        CASE WHEN n = 0 THEN 'GOOD' ELSE 'ALERT' END AS status, n AS value
        FROM (SELECT count(*) FILTER (NOT coalesce({rule}, false)) AS n FROM lineitem)"""
        for k, c, rule in _RULES[:3]
    )
    + """ UNION ALL SELECT 'r4', '1.main.lineitem.l_comment', 'ATTRIBUTE', 'UNKNOWN', NULL""",
)
def dq_evaluate(t):
    return Q.dq_evaluate(t.lineitem, "1.main.lineitem", _RULES)


@query(
    "flag_tables",
    """WITH lost AS (SELECT n_regionkey AS ds, lower(n_name) || '.t' || c_custkey AS tb
                     FROM customer JOIN nation ON c_nationkey = n_nationkey
                     WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))
    SELECT ds, (rn - 1) // 10 AS part, 'WARNING' AS flag_type, CASE WHEN ds < 2 THEN 'update' ELSE 'create' END AS op,
      (CASE WHEN ds < 2 AND (rn - 1) // 10 = 0 THEN 'Old news. ' ELSE '' END) || 'Missing tables: '
      || string_agg(tb, ', ' ORDER BY rn) AS flag_reason
    FROM (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY tb) AS rn FROM lost) GROUP BY ds, (rn - 1) // 10""",
)
def flag_tables(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    lost = X.tables(t).join(urgent, "id", "left_anti").select(
        F.split("key", r"\.")[0].cast("int").alias("ds"), F.concat_ws(".", "schema", "table").alias("table")
    )
    flags = t.region.where("r_regionkey < 2").select(
        F.col("r_regionkey").alias("ds"), F.lit("Old news. ").alias("flag_reason")
    )
    return Q.flag_tables(lost, flags, size=10)


def _schema_docs(t):
    """A schema document per 50 orders: orders as records, their status and priority as leaves."""
    leaf = lambda name, kind, c: F.struct(
        F.lit(name).alias("name"), F.lit(kind).alias("type"), F.col(c).alias("description"),
        F.array(c).alias("examples"),
    )
    record = F.struct(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("name"),
        F.lit("RECORD").alias("type"),
        F.lit("REPEATED").alias("mode"),
        F.array(leaf("status", "STRING", "o_orderstatus"), leaf("urgency", "STRING", "o_orderpriority")).alias("fields"),
    )
    piece = F.floor(F.col("o_orderkey") / 50).cast("string")
    return t.orders.groupBy(piece.alias("doc")).agg(
        F.to_json(F.array_sort(F.collect_list(record))).alias("fields")
    )


@query(
    "flatten_schema",
    """WITH o AS (SELECT '' || (o_orderkey // 50) AS doc, 'o' || o_orderkey AS name, o_orderstatus AS s,
                  o_orderpriority AS p, row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY 'o' || o_orderkey) AS rn
                  FROM orders)
    SELECT doc, NULL AS parent, name AS path, name, 'RECORD' AS type, 'REPEATED' AS mode, NULL AS title,
           NULL AS description, NULL AS examples, false AS is_leaf, 1 AS level, rn * 3 - 2 AS seq FROM o
    UNION ALL SELECT doc, name, name || '.status', 'status', 'STRING', NULL, NULL, s, '["' || s || '"]', true, 2, rn * 3 - 1 FROM o
    UNION ALL SELECT doc, name, name || '.urgency', 'urgency', 'STRING', NULL, NULL, p, '["' || p || '"]', true, 2, rn * 3 FROM o""",
)
def flatten_schema(t):
    return S.flatten_schema(_schema_docs(t))


@query(
    "encode_schema",
    """SELECT '' || (o_orderkey // 50) AS doc, '{"type":"object","properties":{' || string_agg(
        '"o' || o_orderkey || '":{"type":"array","items":{"properties":{"status":{"type":"STRING","description":"'
        || o_orderstatus || '","examples":["' || o_orderstatus || '"]},"urgency":{"type":"STRING","description":"'
        || o_orderpriority || '","examples":["' || o_orderpriority || '"]}}}}',
        ',' ORDER BY 'o' || o_orderkey) || '}}' AS json FROM orders GROUP BY 1""",
)
def encode_schema(t):
    return S.encode_schema(S.flatten_schema(_schema_docs(t)))
