"""Registered queries: aggregates and group positions."""

from pyspark.sql import functions as F

from shelfmark.operators import aggregates as A
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query

TERMS = """SELECT term, count(*) AS count FROM
    (SELECT unnest(string_split_regex(lower(text), '[\\W0-9]')) AS term FROM {table})
    GROUP BY term"""


@query("thread_terms", TERMS.format(table="conversations"))
def thread_terms(t):
    return A.term_counts(t.conversations, "text")


@query("term_counts", TERMS.format(table="documents"))
def term_counts(t):
    return A.term_counts(t.documents, "text")


@query(
    "term_counts_words",
    TERMS.format(table="documents").replace("GROUP BY", "WHERE term <> '' GROUP BY"),
)
def term_counts_words(t):
    return A.term_counts(t.documents, "text", drop_empty=True)


@query("count_by", "SELECT event_type, count(*) / 1e6 AS count FROM events GROUP BY event_type")
def count_by(t):
    return A.count_by(t.events, ["event_type"], scale=1e6)


@query(
    "count_null",
    """SELECT count(*) FILTER (quality IS NULL) AS nulls, count(quality) AS filled
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def count_null(t):
    return A.count_null(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), "quality")


@query("distinct_days", "SELECT count(DISTINCT date_trunc('day', ts)) AS days FROM events")
def distinct_days(t):
    return A.distinct_days(t.events, "ts")


@query(
    "dir_rollup",
    """SELECT split_part(url, '/', 3) AS archive, split_part(url, '/', 4) AS dir,
       count(*) AS files, sum(length(html)) / 1048576 AS mb
       FROM pages GROUP BY 1, 2 HAVING count(*) > 2""",
)
def dir_rollup(t):
    parts = F.split("url", "/")
    files = t.pages.select(
        F.get(parts, F.lit(2)).alias("archive"),
        F.coalesce(F.get(parts, F.lit(3)), F.lit("")).alias("dir"),
        F.length("html").alias("size"),
    )
    return A.dir_rollup(files, ["archive", "dir"])


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_values(t):
    return A.distinct_values(t.part, ["p_brand", "p_type"])


@query("duplicate_keys", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(t):
    return A.duplicate_keys(t.part, ["p_name"])


@query(
    "duplicate_rows",
    """SELECT p_partkey, p_name, p_size FROM (SELECT *, row_number() OVER
       (PARTITION BY p_name, p_size ORDER BY p_partkey) AS rn FROM part) WHERE rn > 1""",
)
def duplicate_rows(t):
    rows = t.part.select("p_partkey", "p_name", "p_size")
    return A.duplicate_keys(rows, ["p_name", "p_size"], keep="first", order=["p_partkey"])


@query(
    "string_agg",
    """SELECT c_mktsegment, (rn - 1) // 20 AS part, string_agg(c_name, '; ' ORDER BY rn) AS c_name
       FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS rn FROM customer)
       GROUP BY 1, 2""",
)
def string_agg(t):
    return A.string_agg(
        t.customer.select("c_mktsegment", "c_name"),
        ["c_mktsegment"], "c_name", "; ", ["c_name"], size=20,
    )


@query(
    "collect_children",
    """SELECT o_custkey, (rn - 1) // 8 AS part, string_agg(o_orderkey, ',' ORDER BY rn) AS children
       FROM (SELECT o_custkey, o_orderkey,
                    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
       GROUP BY 1, 2""",
)
def collect_children(t):
    lists = A.collect_children(t.orders.select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 8)
    return lists.withColumn("children", F.array_join("children", ","))


@query("min_max", "SELECT min(o_orderkey) AS min, max(o_orderkey) AS max FROM orders")
def min_max(t):
    return A.min_max(t.orders, "o_orderkey")


@query(
    "recent_n_blocks",
    """SELECT o_orderstatus, count(*) AS count FROM orders
       WHERE o_orderkey >= (SELECT max(o_orderkey) FROM orders) - 1000 GROUP BY 1""",
)
def recent_n_blocks(t):
    return A.recent_n_blocks(t.orders, "o_orderkey", 1000, "o_orderstatus")


@query(
    "first_per_group",
    """SELECT l_orderkey, arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS l_returnflag
       FROM lineitem GROUP BY 1""",
)
def first_per_group(t):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return A.first_per_group(t.lineitem, ["l_orderkey"], "l_returnflag", order)


@query(
    "message_frequency",
    """SELECT capture, count(*) AS count FROM
       (SELECT regexp_extract(text, '(\\w+) (?:the|les|die)[ .,]', 1) AS capture FROM documents)
       WHERE capture <> '' GROUP BY 1""",
)
def message_frequency(t):
    return A.message_frequency(t.documents, "text", r"(\w+) (?:the|les|die)[ .,]")


@query(
    "group_members",
    """SELECT c_custkey AS "user", c_mktsegment AS "group" FROM customer
       UNION SELECT o_custkey, o_orderpriority FROM orders
       JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'""",
)
def group_members(t):
    group = lambda name, builtin: F.struct(
        F.col(name).alias("name"), builtin.alias("is_builtin")
    )
    users = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "right").select(
        F.col("c_custkey").alias("user"),
        F.array(
            group("c_mktsegment", F.lit(False)),
            group("o_orderpriority", F.coalesce(F.col("o_orderpriority") == "5-LOW", F.lit(True))),
        ).alias("groups"),
    )
    return A.group_members(users)


_JOBS = """SELECT o_orderstatus AS status, o_orderkey AS id, o_orderstatus = 'F' AS failed FROM orders"""


def _jobs(t):
    failed = F.col("o_orderstatus") == "F"
    key = F.concat(F.lit("k"), F.col("o_orderkey").cast("string"))
    mapping = F.when(~failed, F.array(F.struct(key.alias("key"), F.col("o_orderkey").alias("id"))))
    errors = F.when(failed, F.array(F.lit("no parent"), F.lit("no name")))
    return t.orders.select(
        F.col("o_orderstatus").alias("status"),
        F.array(F.struct(mapping.alias("mapping"), errors.alias("errors"))).alias("result"),
    )


@query(
    "load_summary",
    f"""SELECT status, count(*) AS jobs, count(*) FILTER (NOT failed) AS mapped,
        2 * count(*) FILTER (failed) AS errors FROM ({_JOBS}) GROUP BY 1""",
)
def load_summary(t):
    counts, _ = A.load_summary(_jobs(t))
    return counts


@query("load_mapping", f"SELECT 'k' || id AS key, id FROM ({_JOBS}) WHERE NOT failed")
def load_mapping(t):
    _, mapping = A.load_summary(_jobs(t))
    return mapping


@query(
    "thread_root",
    """SELECT conv_id, turn, role, min(turn) OVER (PARTITION BY conv_id) AS root,
       count(*) OVER (PARTITION BY conv_id) AS thread_size FROM conversations""",
)
def thread_root(t):
    return A.thread_root(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn")


@query(
    "thread_root_nested",
    """SELECT conv_id * 4294967296 + turn AS no,
       min(conv_id * 4294967296 + turn) OVER (PARTITION BY conv_id) AS ori_post,
       count(*) OVER (PARTITION BY conv_id) AS replies_top FROM conversations""",
)
def thread_root_nested(t):
    posts = X.threads(t).select("conv_id", F.explode("posts").alias("p")).select("conv_id", "p.no")
    found = A.thread_root(posts, "conv_id", "no")
    return found.select("no", F.col("root").alias("ori_post"), F.col("thread_size").alias("replies_top"))


@query(
    "position_in_group",
    f"""WITH {X.COLUMNS}
    SELECT table_name, column_name, row_number() OVER
      (PARTITION BY table_name ORDER BY column_name, title) AS position FROM cat""",
)
def position_in_group(t):
    cat = X.columns(t).select("table_name", "column_name", "title")
    return A.position_in_group(cat, ["table_name"], ["column_name", "title"]).drop("title")


@query(
    "position_in_large_group",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, row_number() OVER
       (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position
       FROM lineitem""",
)
def position_in_large_group(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.lineitem.select("l_returnflag", *order)
    return A.position_in_group(rows, ["l_returnflag"], order).drop("l_suppkey", "l_extendedprice")


@query(
    "top_n_per_group",
    """SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER
       (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
       WHERE rank <= 3""",
)
def top_n_per_group(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    top = A.top_n_per_group(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
    return top.drop("o_totalprice")


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_per_key(t):
    latest = A.latest_per_key(t.events, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type")


@query(
    "dedup_keep",
    """SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER
       (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def dedup_keep(t):
    rows = t.events.select("user_id", "event_type", "event_id")
    return A.dedup_keep(rows, ["user_id", "event_type"], ["event_id"], "first")
