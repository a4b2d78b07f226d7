"""Registered queries: projections, filters, sorts and set operations."""

import datetime as dt

from pyspark.sql import functions as F

from shelfmark.functions import text, values
from shelfmark.operators import relational as R
from shelfmark.operators.paging import PageIndex
from shelfmark.operators.search import TermIndex
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query


@query(
    "nested_project",
    """SELECT conv_id * 4294967296 + turn AS number, role AS author, text FROM conversations""",
)
def nested_project(t):
    posts = X.threads(t).select(F.explode("posts").alias("p"))
    return R.nested_project(posts, {"number": "p.no", "author": "p.role", "text": "p.com"})


@query("select_existing", "SELECT c_custkey, c_name FROM customer")
def select_existing(t):
    found, _ = R.select_existing(t.customer, ["c_custkey", "c_phone", "c_name", "c_name.first"])
    return found


# fixed values: steps of log10 and their labels, highest first
_STEPS = [(5.5, "huge"), (5.0, "big"), (4.0, "medium")]


@query(
    "case_bucket",
    """SELECT o_orderkey, CASE WHEN log10(o_totalprice) > 5.5 THEN 'huge'
       WHEN log10(o_totalprice) > 5.0 THEN 'big' WHEN log10(o_totalprice) > 4.0 THEN 'medium'
       ELSE 'other' END AS bucket FROM orders""",
)
def case_bucket(t):
    bucket = values.case_bucket(F.log10("o_totalprice"), _STEPS, "other")
    return t.orders.select("o_orderkey", bucket.alias("bucket"))


@query(
    "filter_predicates",
    """SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'
       AND event_type NOT LIKE 'sign%' AND value IS NOT NULL
       AND regexp_matches(props, '"k": [1-4]')""",
)
def filter_predicates(t):
    return R.filter_predicates(
        t.events,
        F.col("event_type") != "error",
        "event_type not like 'sign%'",
        F.col("value").isNotNull(),
        F.col("props").rlike('"k": [1-4]'),
    ).select("event_id", "event_type", "value")


@query(
    "match_modes",
    """SELECT p_partkey, p_name = 'red widget' AS exact, lower(p_name) = 'red widget' AS iexact,
       contains(lower(p_name), 'ring') AS contains, p_name LIKE 'small%' AS startswith,
       lower(p_name) LIKE 'r_d%' AS glob FROM part""",
)
def match_modes(t):
    asked = [
        ("exact", "red widget"), ("iexact", "RED Widget"), ("contains", "RING"),
        ("startswith", "small"), ("glob", "R?d*"),
    ]
    return t.part.select(
        "p_partkey", *[text.match_modes("p_name", v, mode).alias(mode) for mode, v in asked]
    )


@query(
    "token_search",
    """SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr') AND
       list_has_any(string_split_regex(lower(text), '\\W+'), ['with', 'avec'])""",
)
def token_search(t):
    return R.token_search(
        t.documents, "text", "With AVEC", otypes=["en", "fr"], otype_col="lang"
    ).select("doc_id", "lang")


@query(
    "rename_drop",
    """SELECT c_custkey AS id, c_name AS title, c_mktsegment AS "group" FROM customer""",
)
def rename_drop(t):
    return R.rename_drop(
        t.customer,
        {"c_custkey": "id", "c_name": "title", "c_mktsegment": "group"},
        drop=["c_acctbal", "c_nationkey"],
    )


@query(
    "coerce_clean",
    """SELECT event_id, CAST(round_even(value, 0) AS BIGINT) AS whole,
       CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value END AS amount,
       CASE WHEN event_id % 5 = 0 THEN 'null' ELSE event_type END AS label,
       CASE WHEN event_type = 'view' THEN 'dashboard' ELSE 'simple' END AS kind,
       CASE WHEN event_id % 4 = 0 THEN substr(sha256('' || event_id), 1, 16)
            ELSE 'x' || event_id END AS external_id FROM events""",
)
def coerce_clean(t):
    key = F.col("event_id")
    raw = t.events.select(
        "event_id",
        F.col("value").cast("string").alias("whole"),
        F.when(key % 3 != 0, F.col("value")).alias("amount"),
        F.when(key % 5 != 0, F.col("event_type")).alias("label"),
        F.when(F.col("event_type") == "view", F.lit("DashBoard")).when(key % 2 == 0, F.lit("x")).alias("kind"),
        F.when(key % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("x"), key.cast("string"))).alias("external_id"),
    )
    cleaned = R.coerce_clean(
        raw, {"whole": "int", "amount": "float", "label": "text", "kind": "report_type"}
    )
    return cleaned.withColumn("external_id", values.valid_external_id("external_id", "event_id"))


@query(
    "fill_defaults",
    """SELECT d.doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, d.doc_id % 2) AS toxic,
       '2024-02-01 00:00:00' AS ts_updated FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def fill_defaults(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    filled = R.fill_defaults(
        joined.withColumn("ts_updated", F.lit(None).cast("timestamp")),
        {"quality": -1, "toxic": F.col("doc_id") % 2, "ts_updated": "now"},
        as_of=dt.datetime(2024, 2, 1, tzinfo=dt.UTC),
    )
    return filled.withColumn("ts_updated", F.date_format("ts_updated", "yyyy-MM-dd HH:mm:ss"))


@query(
    "prune_empty",
    """SELECT doc_id, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id)
       WHERE quality IS NOT NULL OR toxic IS NOT NULL""",
)
def prune_empty(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return R.prune_empty(joined, ["quality", "toxic"])


@query(
    "sort_keys",
    """SELECT c_custkey, c_mktsegment, row_number() OVER
       (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS place FROM customer""",
)
def sort_keys(t):
    from shelfmark.skew import number_rows

    order = [F.asc("c_mktsegment"), F.desc("c_acctbal"), F.asc("c_custkey")]
    numbered = number_rows(t.customer, order, "place")
    return R.sort_keys(numbered.select("c_custkey", "c_mktsegment", "place"), "place")


@query(
    "top_k",
    """SELECT l_partkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
       FROM lineitem GROUP BY l_partkey ORDER BY cents DESC, l_partkey LIMIT 20""",
)
def top_k(t):
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents")
    revenue = t.lineitem.groupBy("l_partkey").agg(cents)
    return R.top_k(revenue, [F.desc("cents"), "l_partkey"], 20)


_SEARCHED = """WITH words AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\\W+')) AS term FROM documents),
  hits AS (SELECT doc_id, term, count(*) AS times FROM words WHERE term IN ('with', 'the', 'avec') GROUP BY ALL),
  weighed AS (SELECT *, ln(1 + (SELECT count(*) FROM documents)::DOUBLE / count(*) OVER (PARTITION BY term)) AS w FROM hits)
  SELECT doc_id AS id, count(*) AS n_terms, round(sum(times * w), 4) AS score FROM weighed GROUP BY doc_id"""


@query("ranked_search", _SEARCHED)
def ranked_search(t):
    return TermIndex.build(t.documents, "doc_id", "text").search("with THE, avec the")


@query("ranked_search_all", f"{_SEARCHED} HAVING count(*) = 3 ORDER BY score DESC, id LIMIT 100")
def ranked_search_all(t):
    return TermIndex.build(t.documents, "doc_id", "text").search("avec the with", mode="all", k=100)


@query(
    "page_slice",
    "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 100 OFFSET 100",
)
def page_slice(t):
    return R.page_slice(t.part, ["p_name", "p_partkey"], 100, 100).select("p_partkey", "p_name")


@query(
    "page_slice_falling",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment DESC, c_acctbal, c_custkey LIMIT 50 OFFSET 70",
)
def page_slice_falling(t):
    index = PageIndex(t.customer, ["-c_mktsegment", "c_acctbal", "c_custkey"], rows=100)
    return index.page(50, 70).select("c_custkey", "c_mktsegment", "c_acctbal")


@query(
    "page_slice_deep",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem "
    "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice "
    "LIMIT 100 OFFSET 20000",
)
def page_slice_deep(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.lineitem.select(order)
    return R.page_slice(rows, order, 100, 20_000).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "union_loose",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
       FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_loose(t):
    return R.union_loose(
        t.customer.selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment"),
        t.supplier.selectExpr("s_suppkey as id", "s_name as name", "s_acctbal as balance"),
    )


@query(
    "intersect_keys",
    "SELECT o_custkey AS custkey FROM orders INTERSECT SELECT c_custkey FROM customer",
)
def intersect_keys(t):
    return R.intersect_keys(
        t.orders.select(F.col("o_custkey").alias("custkey")),
        t.customer.select(F.col("c_custkey").alias("custkey")),
        ["custkey"],
    )


@query("except_keys", "SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels")
def except_keys(t):
    return R.except_keys(t.documents, t.labels, ["doc_id"])


@query(
    "union_distinct",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(t):
    return R.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nationkey")), t.supplier.select("s_nationkey")
    )
