"""Folder and article trees given as an edge list (node, parent)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import hash_id, parent_path
from shelfmark.operators.aggregates import top_n_per_group
from shelfmark.operators.lookups import policy_lookup, unique_lookup
from shelfmark.skew import joined_lists, lookup_join, number_rows
from shelfmark.session import hand_over


def ancestry(
    nodes: DataFrame, node_id: str, parent: str, labels: Sequence[str] = ()
) -> DataFrame:
    """Add the ``trail`` of each node from the top down to itself, and a ``status``.

    ``trail`` is an array of structs with the labels and the id. Nodes with children come
    first: each round joins the open ones with their nearest ancestor not yet in the trail and
    takes over that ancestor's whole trail, so trails double and the rounds grow with the
    logarithm of the depth, and a round writes the open nodes only. All other nodes, the bulk of
    most trees, are joined once to their parent.
    Status is ``ok``, ``missing parent`` or ``cycle``; in the latter case the trail stops where
    it would repeat.
    """
    own = F.struct(*[F.col(label) for label in labels], F.col(node_id).alias("node"))
    start = nodes.select(
        F.col(node_id).alias("node"),
        F.col(parent).alias("up"),
        F.array(own).alias("trail"),
        F.lit("ok").alias("status"),
    )
    parents = start.select(F.col("up").alias("node"), F.lit(True).alias("has_children"))
    marked = hand_over(
        start.join(parents.where("node is not null").distinct(), "node", "left"), "ancestry"
    )
    inner = marked.where("has_children").drop("has_children")
    done, open_nodes = inner.where("up is null"), inner.where("up is not null")
    while not open_nodes.isEmpty():
        step = hand_over(_extended(open_nodes, done.unionByName(open_nodes)), "ancestry")
        done = done.unionByName(step.where("up is null"))
        open_nodes = step.where("up is not null")
    leaves = marked.where("has_children is null").drop("has_children")
    found = done.unionByName(leaves.where("up is null")).unionByName(
        _extended(leaves.where("up is not null"), done)
    )
    return nodes.join(
        found.select(F.col("node").alias(node_id), "trail", "status"), node_id
    )


def _extended(open_nodes: DataFrame, state: DataFrame) -> DataFrame:
    """Nodes with the trail of the ancestor ``up`` put before their own."""
    above = state.select(
        F.col("node").alias("up"),
        F.col("up").alias("next_up"),
        F.col("trail").alias("upper"),
        F.col("status").alias("upper_status"),
    )
    lost = F.col("upper").isNull()
    stepped = lookup_join(open_nodes, above, "up").select(
        "node",
        "next_up",
        F.when(lost, F.col("trail")).otherwise(F.concat("upper", "trail")).alias("trail"),
        F.when(lost, F.lit("missing parent")).otherwise(F.col("upper_status")).alias("status"),
    )
    repeats = F.coalesce(
        F.array_contains(F.transform("trail", lambda t: t["node"]), F.col("next_up")), F.lit(False)
    )
    return stepped.select(
        "node",
        F.when((F.col("status") == "ok") & ~repeats, F.col("next_up")).alias("up"),
        "trail",
        F.when(repeats, F.lit("cycle")).otherwise(F.col("status")).alias("status"),
    )


def orphans(nodes: DataFrame, node_id: str, parent: str) -> DataFrame:
    """Objects whose parent is not there, and all that hang below such objects.

    ``reason`` is ``parent missing`` for the former, ``parent left out`` for the latter.
    """
    found = ancestry(nodes, node_id, parent).where("status = 'missing parent'")
    reason = F.when(F.size("trail") == 1, F.lit("parent missing")).otherwise("parent left out")
    return found.withColumn("reason", reason).drop("trail", "status")


def depths(nodes: DataFrame, node_id: str, parent: str) -> DataFrame:
    """Add the number of steps up to the top as ``depth``, and the ``status`` as in ``ancestry``.

    Each round a node's pointer jumps to where its target points, so steps double; only open
    nodes are written, without a trail. What is still open when steps could be as many as there
    are nodes goes round in, or hangs below, a cycle.
    """
    start = hand_over(
        nodes.select(
            F.col(node_id).alias("node"),
            F.col(parent).alias("up"),
            F.when(F.col(parent).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("depth"),
            F.lit("ok").alias("status"),
        ),
        "depths",
    )
    done, open_nodes = start.where("up is null"), start.where("up is not null")
    for _ in range(start.count().bit_length() + 1):
        if open_nodes.isEmpty():
            break
        above = done.unionByName(open_nodes).select(
            F.col("node").alias("up"),
            F.col("up").alias("next_up"),
            F.col("depth").alias("further"),
            F.col("status").alias("upper"),
        )
        step = hand_over(
            lookup_join(open_nodes, above, "up").select(
                "node",
                F.col("next_up").alias("up"),
                (F.col("depth") + F.coalesce("further", F.lit(0))).alias("depth"),
                F.coalesce("upper", F.lit("missing parent")).alias("status"),
            ),
            "depths",
        )
        done = done.unionByName(step.where("up is null"))
        open_nodes = step.where("up is not null")
    found = done.unionByName(open_nodes.withColumn("status", F.lit("cycle")))
    return nodes.join(
        found.select(F.col("node").alias(node_id), "depth", "status"), node_id
    )


def folder_path(
    nodes: DataFrame, node_id: str, parent: str, name: str, sep: str = "//"
) -> DataFrame:
    """Full path of names for every node; empty for nodes that hang below no root."""
    found = ancestry(nodes, node_id, parent, [name])
    names = F.array_join(F.transform("trail", lambda t: t[name]), sep)
    return found.withColumn(
        "path", F.when(F.col("status") == "ok", names).otherwise(F.lit(""))
    ).drop("trail", "status")


def path_prefixes(df: DataFrame, path: str, sep: str = "/") -> DataFrame:
    """The distinct folders that paths imply, each with its parent and level."""
    parts = F.transform(F.split(path, "\\Q" + sep + "\\E"), lambda part: F.trim(part))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size("_parts")),
        lambda i: F.struct(
            F.array_join(F.slice("_parts", 1, i), sep).alias("node"),
            F.when(i > 1, F.array_join(F.slice("_parts", 1, i - 1), sep)).alias("parent"),
            i.alias("level"),
        ),
    )
    return (
        df.where(F.col(path).isNotNull())
        .select(parts.alias("_parts"))
        .select(F.explode(prefixes).alias("p"))
        .select("p.*")
        .distinct()
    )


def human_readable(objects: DataFrame) -> DataFrame:
    """Qualified names for folders and reports; technical ids are dropped.

    A folder is named by its path, a report by its folder's path and its own name.
    """
    folders = objects.where("otype = 'bi_folder'")
    reports = objects.where("otype = 'bi_report'")
    named_folders = folders.withColumn("fully_qualified_name", F.col("path")).withColumn(
        "parent", parent_path("path", "//")
    )
    dim = named_folders.select(
        F.col("external_id").alias("parent_folder"), F.col("fully_qualified_name").alias("parent")
    )
    named_reports = unique_lookup(reports, dim, "parent_folder", "parent").withColumn(
        "fully_qualified_name", F.concat("parent", F.lit("||"), "name")
    )
    return named_folders.unionByName(named_reports).drop("external_id", "parent_folder", "report")


def assign_external_ids(objects: DataFrame, n: int = 16) -> DataFrame:
    """Ids from qualified names, and the id of each object's parent.

    ``parent`` holds the parent's qualified name. Objects flagged ``delete`` are left out. An
    object whose parent is not among the others gets no id (folder, below a parent that is
    not there) and no parent id. Check the result with ``duplicate_keys``.
    """
    live = objects.where("action is null or action <> 'delete'")
    sep = F.when(F.col("otype") == "bi_folder", F.lit("//")).otherwise(F.lit("||"))
    named = live.withColumn(
        "fully_qualified_name",
        F.when(F.col("parent").isNull(), F.col("name")).otherwise(
            F.concat("parent", sep, "name")
        ),
    ).withColumn("_hash", hash_id("fully_qualified_name", "sha256", n))
    dim = named.groupBy(F.col("fully_qualified_name").alias("parent")).agg(
        F.min("_hash").alias("_parent_id")
    )
    is_col = F.col("otype") == "bi_report_column"
    lost = F.col("parent").isNotNull() & F.col("_parent_id").isNull()
    return (
        lookup_join(named, dim, "parent")
        .withColumn("external_id", F.when(~lost, F.col("_hash")))
        .withColumn("parent_folder", F.when(~is_col, F.col("_parent_id")))
        .withColumn("report", F.when(is_col, F.col("_parent_id")))
        .drop("_hash", "_parent_id")
    )


def creation_levels(
    nodes: DataFrame, node_id: str, parent: str, existing: DataFrame | None = None
) -> DataFrame:
    """Round in which each node can be created so that parents come before children.

    Nodes whose parent is already on the target count as top level. ``status`` tells nodes
    that cannot be created: the parent is missing, or there is a cycle.
    """
    if existing is not None:
        known = existing.select(F.col(node_id).alias(parent), F.lit(True).alias("_known"))
        nodes = lookup_join(nodes, known.distinct(), parent).withColumn(
            parent, F.when(F.col("_known").isNull(), F.col(parent))
        ).drop("_known")
    found = depths(nodes, node_id, parent)
    level = F.when(F.col("status") == "ok", F.col("depth")).cast("int")
    return found.withColumn("level", level).drop("depth")


def _from_start(found: DataFrame, root: Column) -> DataFrame:
    """Add ``reached``, the ``start`` of the visit and the ``steps`` from there to the node."""
    ids = F.transform("trail", lambda t: t["node"])
    reached = F.array_contains(ids, root)
    start = F.when(reached, root).otherwise(F.array_min(ids))
    return (
        found.withColumn("reached", reached)
        .withColumn("start", start)
        .withColumn(
            "steps",
            F.slice("trail", F.array_position(ids, F.col("start")).cast("int"), F.size("trail")),
        )
    )


def preorder(
    nodes: DataFrame, node_id: str, parent: str, order: str, root: object
) -> DataFrame:
    """Number nodes with children directly after their parent, siblings by ``order``.

    Nodes not below ``root`` come last: by id, each followed by those of its descendants that
    have no lower id above them. Arrays compare element by element, so sorting by the trail is
    the pre-order.
    """
    found = _from_start(ancestry(nodes, node_id, parent, [order]), F.lit(root))
    order_by = [F.desc("reached"), F.asc("start"), F.asc("steps")]
    return number_rows(found, order_by, "seq").drop("trail", "steps", "start", "status")


def postorder(
    nodes: DataFrame, node_id: str, parent: str, order: str, root: object
) -> DataFrame:
    """Number the nodes below ``root``: childless ones first, last visited first, then inner
    nodes, each after its descendants."""
    parents = nodes.where(F.col(parent).isNotNull()).select(
        F.col(parent).alias(node_id), F.lit(True).alias("inner")
    )
    marked = nodes.join(parents.distinct(), node_id, "left").withColumn(
        "inner", F.coalesce("inner", F.lit(False))
    )
    found = _from_start(ancestry(marked, node_id, parent, [order]), F.lit(root)).where("reached")
    # a closing element that sorts after every child makes a node follow its descendants
    visit = F.transform("steps", lambda s: F.struct(F.lit(0).alias("closing"), s.alias("step")))
    nothing = F.lit(None).cast(found.schema["steps"].dataType.elementType)
    closing = F.array(F.struct(F.lit(1).alias("closing"), nothing.alias("step")))
    keyed = found.withColumn("_leaf", F.when(~F.col("inner"), F.col("steps"))).withColumn(
        "_inner", F.when(F.col("inner"), F.concat(visit, closing))
    )
    numbered = number_rows(keyed, [F.asc("inner"), F.desc("_leaf"), F.asc("_inner")], "seq")
    return numbered.drop("trail", "steps", "start", "reached", "status", "_leaf", "_inner")


def remap_children(
    source: DataFrame, target: DataFrame, on: str = "title", size: int = 10_000
) -> DataFrame:
    """Child links that the target still lacks, with the target's ids, in parts of ``size``.

    Both sides have ``id``, the title and an array ``children`` of ids; an object with many
    children may have several rows. Of a title that the target holds more than once, the lowest
    id counts.
    """
    titles = source.select(F.col("id").alias("child"), F.col(on).alias("_child_title")).distinct()
    edges = source.select(F.col(on).alias("_parent_title"), F.explode("children").alias("child"))
    named = lookup_join(edges, titles, "child", "inner")
    dim = target.select(F.col(on).alias("_title"), F.col("id").alias("_found"))
    for side in ("parent", "child"):
        named = policy_lookup(
            named.withColumnRenamed(f"_{side}_title", "_title"), dim, "_title", "_found", "_found"
        ).drop("_title").withColumnRenamed("_found", f"target_{side}")
    linked = target.select(
        F.col("id").alias("target_parent"), F.explode("children").alias("target_child")
    )
    fresh = (
        named.where("target_parent is not null and target_child is not null")
        .select("target_parent", "target_child")
        .distinct()
        .join(linked, ["target_parent", "target_child"], "left_anti")
    )
    return joined_lists(
        fresh, ["target_parent"], ["target_child"], F.col("target_child"), size, "new_children"
    )


def folder_digest(folders: DataFrame, reports: DataFrame, n: int = 25) -> DataFrame:
    """Description text per folder: its report count and links to the first ``n`` reports."""
    counts = reports.groupBy(F.col("parent_folder").alias("external_id")).agg(
        F.count("*").alias("reports")
    )
    link = F.concat(
        F.lit('<p><a data-oid="'), F.col("id"), F.lit('" data-otype="bi_report" href="/bi/v2/report/'),
        F.col("id"), F.lit('/"></a></p>\n'),
    )
    shown = top_n_per_group(reports, ["parent_folder"], [F.asc("id")], n)
    links = shown.groupBy(F.col("parent_folder").alias("external_id")).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("rank", link.alias("link")))),
                lambda i: i["link"],
            ),
            "",
        ).alias("links")
    )
    n_reports = F.coalesce("reports", F.lit(0))
    return (
        folders.join(counts, "external_id", "left")
        .join(links, "external_id", "left")
        .select(
            "external_id",
            n_reports.alias("reports"),
            F.concat(
                F.lit("<p>There are "), n_reports.cast("string"),
                F.lit(f" reports in this folder. Showing max {n}.</p>"),
                F.coalesce("links", F.lit("")),
            ).alias("description"),
        )
    )
