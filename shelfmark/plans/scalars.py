"""Registered queries: scalar functions over the given tables."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import dates, html, keys, text, values
from shelfmark.operators.catalog import TYPE_RULES
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query


@query(
    "fqn_build",
    f"""WITH {X.COLUMNS}
    SELECT column_id, ds_id || '.' || schema_name || '.' || table_name || '.'
           || lower(replace(title || '.x', '.', '_')) AS key FROM cat""",
)
def fqn_build(t):
    cat = X.columns(t).withColumn("leaf", F.concat("title", F.lit(".x")))
    key = keys.fqn_build("ds_id", F.upper("schema_name"), "table_name", leaf="leaf")
    return cat.select("column_id", key.alias("key"))


@query(
    "fqn_parse",
    f"""WITH {X.COLUMNS}
    SELECT column_id, ds_id AS ds, (CASE WHEN nullable THEN '' ELSE 'db.' END) || schema_name AS "schema",
           table_name AS "table", column_name AS "column",
           NOT nullable AS dotted FROM cat""",
)
def fqn_parse(t):
    cat = X.columns(t)
    schema = F.concat(F.when(F.col("nullable"), F.lit("")).otherwise(F.lit("db.")), "schema_name")
    key = F.concat_ws(".", F.col("ds_id").cast("string"), schema, "table_name", "column_name")
    parsed = cat.select("column_id", (~F.col("nullable")).alias("dotted"), key.alias("key"))
    return parsed.select("column_id", "dotted", keys.fqn_parse("key", "column").alias("k")).select(
        "column_id", "dotted", "k.*"
    )


@query(
    "path_ops",
    """SELECT page_id, split_part(url, '/', -1) AS leaf,
       array_to_string(string_split(url, '/')[:-2], '/') AS parent FROM pages""",
)
def path_ops(t):
    return t.pages.select(
        "page_id", keys.leaf("url", "/").alias("leaf"), keys.parent_path("url", "/").alias("parent")
    )


@query("hash_id", "SELECT p_partkey, substr(sha256(p_name || '//' || p_brand), 1, 16) AS id FROM part")
def hash_id(t):
    return t.part.select(
        "p_partkey", keys.hash_id(F.concat_ws("//", "p_name", "p_brand")).alias("id")
    )


_CASE = "CASE " + " ".join(
    f"WHEN regexp_matches(data_type, '(?i){p}') THEN '{v}'" for p, v in TYPE_RULES
) + " ELSE data_type END"


@query("regex_map", f"WITH {X.COLUMNS} SELECT column_id, {_CASE} AS mapped FROM cat")
def regex_map(t):
    return X.columns(t).select(
        "column_id", text.regex_map("data_type", TYPE_RULES).alias("mapped")
    )


_HREF = 'href="(https?://)?([^"/]+)'


@query(
    "regex_extract",
    f"""SELECT page_id, array_to_string(regexp_extract_all(html, '{_HREF}', 2), ' ') AS hosts
        FROM pages""",
)
def regex_extract(t):
    hosts = text.regex_extract("html", _HREF, 2)
    return t.pages.select("page_id", F.array_join(hosts, " ").alias("hosts"))


_BLANK = text.BLANK


@query(
    "text_clean",
    rf"""WITH d AS (SELECT doc_id, replace(replace(text, '. ', '.  '), ', ', '’s ') AS x FROM documents),
    p AS (SELECT doc_id, x, regexp_extract_all(x, '[.]+({_BLANK}{{2}})[a-zA-Z]+', 1) AS pairs FROM d),
    u AS (SELECT doc_id, x, list_filter(pairs, lambda v, i: list_position(pairs, v) = i) AS pairs FROM p)
    SELECT doc_id, replace(CASE WHEN len(pairs) = 0 THEN x ELSE
      list_reduce(list_concat([x], pairs), lambda a, b: replace(a, b, ' ')) END, '’', '''') AS clean FROM u""",
)
def text_clean(t):
    odd = F.replace(F.replace("text", F.lit(". "), F.lit(".  ")), F.lit(", "), F.lit("’s "))
    return t.documents.select("doc_id", text.text_clean(odd).alias("clean"))


# the entities that occur in the pages; the ampersand also without its semicolon
@query(
    "html_unescape",
    """SELECT page_id, regexp_replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'),
       '&quot;', '"'), '&amp;?', '&', 'g') AS html FROM pages""",
)
def html_unescape(t):
    return t.pages.select("page_id", text.html_unescape("html").alias("html"))


@query(
    "truncate_label",
    """SELECT p_partkey, substr('Part ' || p_name || ' ' || p_type, 1, 25) AS label,
       CASE WHEN p_partkey > 9999 THEN '' || p_partkey ELSE lpad('' || p_partkey, 4, '0') END AS seq
       FROM part""",
)
def truncate_label(t):
    name = F.concat_ws(" ", "p_name", "p_type")
    return t.part.select(
        "p_partkey",
        text.truncate_label(name, 25, "Part ").alias("label"),
        text.seq_label("p_partkey").alias("seq"),
    )


@query(
    "url_codec",
    """SELECT page_id, replace(url_encode(url), '%2F', '/') AS encoded, url AS decoded,
       regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages""",
)
def url_codec(t):
    encoded = html.url_enc("url")
    return t.pages.select(
        "page_id",
        encoded.alias("encoded"),
        html.url_dec(encoded).alias("decoded"),
        html.url_part("url").alias("path"),
    )


@query(
    "substr_after",
    """SELECT c_custkey, split_part(c_name, '#', 2) AS number FROM customer""",
)
def substr_after(t):
    return t.customer.select("c_custkey", text.substr_after("c_name", "#").alias("number"))


@query(
    "date_parts",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS unix, year(ts) AS year,
       month(ts) AS month, day(ts) AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_date
       FROM events""",
)
def date_parts(t):
    epoch = t.events.select("event_id", dates.to_unix("ts").alias("unix"))
    parts = epoch.withColumns(dates.date_parts("unix"))
    return parts.withColumn("full_date", F.date_format("full_date", "yyyy-MM-dd HH:mm:ss"))


@query(
    "relative_date_filter",
    """SELECT event_type, count(*) AS count FROM events
       WHERE CAST(ts AS DATE) = DATE '2024-01-15' - 1 GROUP BY 1""",
)
def relative_date_filter(t):
    parts = t.events.select(
        "event_type", F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM").alias("month"), F.date_format("ts", "dd").alias("day"),
    )
    wanted = dates.relative_date_filter("year", "month", "day", dt.date(2024, 1, 15))
    return parts.where(wanted).groupBy("event_type").agg(F.count("*").alias("count"))


@query(
    "iso_format",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def iso_format(t):
    iso = dates.iso_format("ts")
    return t.events.select("event_id", iso.alias("iso"), F.substr(iso, F.lit(1), F.lit(10)).alias("day"))


@query(
    "math_fns",
    """SELECT o_orderkey, round(log10(o_totalprice), 6) AS log10, o_orderkey / 1048576 AS mb,
       o_orderkey / 1e6 AS millions FROM orders""",
)
def math_fns(t):
    return t.orders.select(
        "o_orderkey",
        values.scaled_log10("o_totalprice").alias("log10"),
        values.megabytes("o_orderkey").alias("mb"),
        (F.col("o_orderkey") / F.lit(1e6)).alias("millions"),
    )


@query(
    "array_fns",
    """SELECT vec_id, embedding[1] AS first, label, len(embedding) AS n,
       array_to_string(list_sort(list_distinct(['t' || (vec_id % 3), 't' || (label % 3)])), ' ') AS kept
       FROM embeddings""",
)
def array_fns(t):
    tag = lambda c, label: F.struct(
        F.concat(F.lit("t"), (F.col(c) % 3).cast("string")).alias("text"), F.lit(label).alias("label")
    )
    tags = F.array(tag("vec_id", "ORG"), tag("label", "PERSON"), tag("vec_id", "DATE"))
    kept = F.array_sort(values.filter_label("tags", "label", ["ORG", "PERSON"], "text"))
    pieces = values.flatten(
        F.array(F.slice("embedding", 1, 10), F.lit(None), F.slice("embedding", 11, 100_000))
    )
    return t.embeddings.withColumn("tags", tags).select(
        "vec_id",
        values.first_elem("embedding").alias("first"),
        "label",
        F.size(pieces).cast("bigint").alias("n"),
        F.array_join(kept, " ").alias("kept"),
    )


@query(
    "json_fns",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'k' AS entry,
       json_extract_string(props, '$.k') AS value FROM events""",
)
def json_fns(t):
    scalar = values.json_scalar("props", "$.k").cast("bigint")
    return t.events.select(
        "event_id", scalar.alias("k"), F.explode(values.json_entries("props")).alias("entry", "value")
    )


@query(
    "json_normalize",
    """SELECT 'e' || event_id AS "r.id", 'user' || user_id AS "r.user.name", event_type AS "r.kind" FROM events""",
)
def json_normalize(t):
    user = F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"))
    record = F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        user.alias("user"),
        F.col("event_type").alias("kind"),
    )
    lines = t.events.select(F.to_json(F.struct(record.alias("r"))).alias("value"))
    schema = T.StructType.fromDDL(
        "r struct<id: string, user: struct<name: string>, kind: string>"
    )
    return values.json_normalize(lines.select(F.from_json("value", schema).alias("v")).select("v.*"))


@query(
    "html_render",
    """SELECT p_partkey, '<table><tbody><tr><td> p_name </td><td> ' || p_name || ' </td></tr>' || chr(10)
       || '<tr><td> p_size </td><td> ' || p_size || ' </td></tr></tbody></table>' AS body,
       '<a data-oid="' || p_partkey || '" data-otype="table" href="/table/' || p_partkey || '/">'
       || p_name || '</a>' AS mention FROM part""",
)
def html_render(t):
    return t.part.select(
        "p_partkey",
        html.html_table(["p_name", "p_size"]).alias("body"),
        html.mention_link("table", "p_partkey", "p_name").alias("mention"),
    )


@query(
    "describe_value",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '/files/' || c_custkey WHEN 1 THEN c_name
       WHEN 2 THEN '/user/' || c_custkey || '/' ELSE 'picker:segment=' || c_mktsegment END AS text
       FROM customer""",
)
def describe_value(t):
    kind = F.col("c_custkey") % 4
    key = F.col("c_custkey").cast("string")
    value = F.struct(
        F.when(kind == 0, F.concat(F.lit("/files/"), key)).alias("download_url"),
        F.when(kind == 1, F.col("c_name")).alias("username"),
        F.when(kind == 2, F.lit("user")).alias("otype"),
        F.when(kind == 2, F.concat(F.lit("/user/"), key, F.lit("/"))).alias("url"),
        F.when(kind == 3, F.lit("segment")).alias("field_name"),
        F.when(kind == 3, F.lit("picker")).alias("value_type"),
        F.when(kind == 3, F.col("c_mktsegment")).alias("value"),
    )
    fields = ["download_url", "username", "otype", "url", "field_name"]
    return t.customer.withColumn("v", value).select(
        "c_custkey", values.describe_value("v", fields).alias("text")
    )
