"""Registered queries: folder trees, external ids and synchronisation."""

from pyspark.sql import functions as F

from shelfmark.operators import hierarchy as H
from shelfmark.operators import sync
from shelfmark.operators.aggregates import collect_children, duplicate_keys
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query
from shelfmark.session import hand_over

_TREE = f"WITH RECURSIVE {X.nodes_sql()}, {X.TRAILS}"
_BROKEN = f"WITH RECURSIVE {X.nodes_sql(broken=True)}, {X.TRAILS}"


@query(
    "folder_path",
    f"""{_BROKEN} SELECT external_id, CASE WHEN ok THEN array_to_string(names, '//') ELSE '' END AS path
    FROM trail""",
)
def folder_path(t):
    paths = H.folder_path(X.nodes(t, broken=True), "external_id", "parent_folder", "name")
    return paths.select("external_id", "path")


@query(
    "path_prefixes",
    """WITH p AS (SELECT string_split(url, '/') AS parts FROM pages),
    e AS (SELECT parts, unnest(generate_series(1, len(parts))) AS level FROM p)
    SELECT DISTINCT array_to_string([trim(x) FOR x IN parts[1:level]], '/') AS node,
      CASE WHEN level > 1 THEN array_to_string([trim(x) FOR x IN parts[1:level - 1]], '/') END AS parent,
      CAST(level AS INT) AS level FROM e""",
)
def path_prefixes(t):
    return H.path_prefixes(t.pages, "url", "/")


@query(
    "human_readable",
    f"""{_TREE}, named AS (SELECT external_id, array_to_string(names, '//') AS path FROM trail)
    SELECT otype, name, CASE WHEN otype = 'bi_folder' THEN x.path END AS path,
      CASE WHEN otype = 'bi_folder' THEN (SELECT p.path FROM named p WHERE p.external_id = n.parent_folder)
           ELSE f.path END AS parent,
      CASE WHEN otype = 'bi_folder' THEN x.path ELSE f.path || '||' || name END AS fully_qualified_name
    FROM nodes n JOIN named x USING (external_id)
    LEFT JOIN named f ON f.external_id = n.parent_folder""",
)
def human_readable(t):
    nodes = X.nodes(t)
    paths = H.folder_path(
        nodes.where("otype = 'bi_folder'"), "external_id", "parent_folder", "name"
    ).select("external_id", "path")
    objects = nodes.join(paths, "external_id", "left").withColumn("report", F.lit(""))
    return H.human_readable(objects)


def _objects(t):
    """Objects with the qualified name of their parent; the folders of one region are gone."""
    nation, region = F.col("n_name"), F.col("r_name")
    nowhere = F.lit(None).cast("string")
    folders = t.region.select(
        F.lit("bi_folder").alias("otype"), region.alias("name"), nowhere.alias("parent"),
        F.when(F.col("r_regionkey") == 1, F.lit("delete")).alias("action"),
    )
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    nations = both.select(F.lit("bi_folder"), "n_name", region, nowhere)
    reports = t.customer.join(both, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lit("bi_report"), "c_name", F.concat_ws("//", region, nation), nowhere
    )
    return folders.union(nations).union(reports)


@query(
    "assign_external_ids",
    """WITH o AS (
      SELECT 'bi_folder' AS otype, r_name AS name, CAST(NULL AS VARCHAR) AS parent,
             CASE WHEN r_regionkey = 1 THEN 'delete' END AS action FROM region
      UNION ALL SELECT 'bi_folder', n_name, r_name, NULL
        FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL SELECT 'bi_report', c_name, r_name || '//' || n_name, NULL
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    named AS (SELECT *, CASE WHEN parent IS NULL THEN name WHEN otype = 'bi_folder'
        THEN parent || '//' || name ELSE parent || '||' || name END AS fqn FROM o WHERE action IS NULL),
    ids AS (SELECT fqn, min(substr(sha256(fqn), 1, 16)) AS id FROM named GROUP BY fqn)
    SELECT n.otype, n.name, n.parent, n.action, n.fqn AS fully_qualified_name,
      CASE WHEN n.parent IS NULL OR p.id IS NOT NULL THEN substr(sha256(n.fqn), 1, 16) END AS external_id,
      p.id AS parent_folder, CAST(NULL AS VARCHAR) AS report
    FROM named n LEFT JOIN ids p ON n.parent = p.fqn""",
)
def assign_external_ids(t):
    return H.assign_external_ids(_objects(t))


@query(
    "duplicate_external_ids",
    """SELECT CASE WHEN n_regionkey = 1 THEN NULL ELSE substr(sha256(r_name || '//' || c_mktsegment), 1, 4) END AS external_id,
       count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_external_ids(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    folders = t.region.select(
        F.lit("bi_folder").alias("otype"), F.col("r_name").alias("name"),
        F.lit(None).cast("string").alias("parent"),
        F.when(F.col("r_regionkey") == 1, F.lit("delete")).alias("action"),
    )
    segments = rows.select(
        F.lit("bi_folder").alias("otype"), F.col("c_mktsegment").alias("name"),
        F.col("r_name").alias("parent"), F.lit(None).cast("string").alias("action"),
    )
    with_ids = H.assign_external_ids(folders.union(segments), n=4).where("parent is not null")
    return duplicate_keys(with_ids, ["external_id"])


@query(
    "creation_levels",
    f"""{_BROKEN}, depth AS (SELECT external_id, parent_folder, ok, len(ids) - 1 AS level FROM trail)
    SELECT n.otype, n.external_id, n.name,
      CASE WHEN n.parent_folder LIKE 'r%' THEN NULL ELSE n.parent_folder END AS parent_folder,
      CASE WHEN ok THEN 'ok' ELSE 'missing parent' END AS status,
      CASE WHEN ok THEN greatest(level - 1, 0) END AS level
    FROM nodes n JOIN depth d USING (external_id)""",
)
def creation_levels(t):
    nodes = X.nodes(t, broken=True)
    existing = t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("external_id"))
    return H.creation_levels(nodes, "external_id", "parent_folder", existing)


# the visit of a node starts at the root, or else at the lowest id on its trail
_STARTS = """starts AS (
  SELECT external_id, list_contains(ids, 'r1') AS reached,
         CASE WHEN list_contains(ids, 'r1') THEN 'r1' ELSE list_min(ids) END AS start, ids, names
  FROM trail),
steps AS (
  SELECT *, list_zip(names, ids)[list_position(ids, start):] AS steps FROM starts)"""


@query(
    "preorder",
    f"""{_TREE}, {_STARTS}
    SELECT n.*, s.reached, row_number() OVER (ORDER BY s.reached DESC, s.start, s.steps) AS seq
    FROM nodes n JOIN steps s USING (external_id)""",
)
def preorder(t):
    return H.preorder(X.nodes(t), "external_id", "parent_folder", "name", "r1")


@query(
    "postorder",
    f"""{_TREE}, {_STARTS},
    marked AS (SELECT n.*, s.steps, n.external_id IN (SELECT parent_folder FROM nodes
               WHERE parent_folder IS NOT NULL) AS "inner" FROM nodes n JOIN steps s USING (external_id)
               WHERE s.reached)
    SELECT otype, external_id, name, parent_folder, "inner",
      row_number() OVER (ORDER BY "inner", CASE WHEN NOT "inner" THEN steps END DESC,
        CASE WHEN "inner" THEN list_append([{{'closing': 0, 'step': s}} FOR s IN steps],
             {{'closing': 1, 'step': NULL}}) END) AS seq FROM marked""",
)
def postorder(t):
    return H.postorder(X.nodes(t), "external_id", "parent_folder", "name", "r1")


@query(
    "remap_children",
    """WITH pairs AS (
      SELECT n_name AS parent_title, c_name AS child_title, n_nationkey + 1000 AS target_parent,
             c_custkey + 9000 AS target_child, c_mktsegment = 'BUILDING' AS linked
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      WHERE c_mktsegment <> 'MACHINERY')
    SELECT target_parent, (rn - 1) // 5 AS part, string_agg(target_child, ',' ORDER BY rn) AS new_children
    FROM (SELECT *, row_number() OVER (PARTITION BY target_parent ORDER BY target_child) AS rn
          FROM pairs WHERE NOT linked) GROUP BY 1, 2""",
)
def remap_children(t):
    def side(customers, parent_shift, child_shift, linked):
        none = F.array().cast("array<bigint>")
        own = customers.where(linked).select("c_nationkey", (F.col("c_custkey") + child_shift).alias("child"))
        lists = collect_children(own, "c_nationkey", "child", size=20)
        parents = t.nation.join(lists, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
            (F.col("n_nationkey") + parent_shift).cast("bigint").alias("id"),
            F.col("n_name").alias("title"),
            F.coalesce("children", none).alias("children"),
        )
        leaves = customers.select(
            (F.col("c_custkey") + child_shift).alias("id"), F.col("c_name").alias("title"),
            none.alias("children"),
        )
        return hand_over(parents.unionByName(leaves), "articles")

    source = side(t.customer, 100_000_000, 0, F.lit(True))
    target = side(
        t.customer.where("c_mktsegment <> 'MACHINERY'"), 1000, 9000, F.col("c_mktsegment") == "BUILDING"
    )
    new = H.remap_children(source, target, "title", size=5)
    return new.withColumn("new_children", F.array_join("new_children", ","))


@query(
    "folder_digest",
    f"""WITH {X.nodes_sql()},
    r AS (SELECT parent_folder, external_id, row_number() OVER
            (PARTITION BY parent_folder ORDER BY external_id) AS rn,
            count(*) OVER (PARTITION BY parent_folder) AS n FROM nodes WHERE otype = 'bi_report')
    SELECT f.external_id, coalesce(max(r.n), 0) AS reports,
      '<p>There are ' || coalesce(max(r.n), 0) || ' reports in this folder. Showing max 25.</p>'
      || coalesce(string_agg('<p><a data-oid="' || r.external_id
         || '" data-otype="bi_report" href="/bi/v2/report/' || r.external_id || '/"></a></p>' || chr(10), ''
         ORDER BY r.rn), '') AS description
    FROM nodes f LEFT JOIN r ON r.parent_folder = f.external_id AND r.rn <= 25
    WHERE f.otype = 'bi_folder' GROUP BY f.external_id""",
)
def folder_digest(t):
    nodes = X.nodes(t)
    reports = nodes.where("otype = 'bi_report'").withColumnRenamed("external_id", "id")
    return H.folder_digest(nodes.where("otype = 'bi_folder'").select("external_id"), reports)


@query(
    "sync_plan",
    """SELECT coalesce(n.id, o.id) AS id, CASE
         WHEN n.action = 'delete' THEN (CASE WHEN o.id IS NOT NULL THEN 'delete' END)
         WHEN n.id IS NULL THEN 'delete' WHEN o.id IS NULL THEN 'create'
         WHEN n.name <> o.name OR n.size <> o.size THEN 'update' ELSE 'keep' END AS op
       FROM (SELECT p_partkey AS id, p_name AS name, p_size + (CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END) AS size,
                    CASE WHEN p_size = 7 THEN 'delete' END AS action
             FROM part WHERE p_type <> 'SMALL') n
       FULL JOIN (SELECT p_partkey AS id, p_name AS name, p_size AS size FROM part WHERE p_brand <> 'Brand#3') o
         ON n.id = o.id
       WHERE NOT (coalesce(n.action, '') = 'delete' AND o.id IS NULL)""",
)
def sync_plan(t):
    changed = F.when(F.col("p_type") == "ECONOMY", F.lit(1)).otherwise(F.lit(0))
    source = t.part.where("p_type <> 'SMALL'").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        (F.col("p_size") + changed).alias("size"),
        F.when(F.col("p_size") == 7, F.lit("delete")).alias("action"),
    )
    target = t.part.where("p_brand <> 'Brand#3'").selectExpr(
        "p_partkey as id", "p_name as name", "p_size as size"
    )
    plan = sync.sync_plan(source, target, ["id"], ["name", "size"], remove_not_seen=True, action="action")
    return plan.select("id", "op")


@query(
    "sync_plan_conflicts",
    """WITH s AS (SELECT CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN p_partkey - 1 ELSE p_partkey END AS id,
                     p_name AS name FROM part WHERE p_size > 10),
       t AS (SELECT CASE WHEN p_partkey % 11 = 0 THEN p_partkey - 2 WHEN p_partkey <> 50 THEN p_partkey END AS id,
                    CASE WHEN p_size > 30 THEN 'x' ELSE p_name END AS name FROM part WHERE p_size < 40 OR p_partkey = 50),
       g AS (SELECT id, sum(a) AS n_source, sum(b) AS n_target, min(x) AS x, min(y) AS y
             FROM (SELECT id, 1 AS a, 0 AS b, name AS x, NULL AS y FROM s UNION ALL SELECT id, 0, 1, NULL, name FROM t) GROUP BY id)
       SELECT id, CASE WHEN n_source > 1 OR n_target > 1 THEN 'conflict' WHEN n_source = 0 THEN 'keep' WHEN n_target = 0 THEN 'create'
         WHEN x <> y THEN 'update' ELSE 'keep' END AS op, CAST(n_source AS BIGINT) AS n_source, CAST(n_target AS BIGINT) AS n_target FROM g""",
)
def sync_plan_conflicts(t):
    key = F.col("p_partkey")
    source = t.part.where("p_size > 10").select(
        F.when(key % 50 == 0, None).when(key % 7 == 0, key - 1).otherwise(key).alias("id"), F.col("p_name").alias("name")
    )
    target = t.part.where("p_size < 40 or p_partkey = 50").select(
        F.when(key % 11 == 0, key - 2).when(key != 50, key).alias("id"),
        F.when(F.col("p_size") > 30, "x").otherwise(F.col("p_name")).alias("name"),
    )
    return sync.sync_plan(source, target, ["id"], ["name"])
