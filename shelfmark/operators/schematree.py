"""Nested record schemas as rows, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import hand_over
from shelfmark.skew import number_in_groups

# lists name their fields and hold inner lists in ``fields`` or ``children``
_LISTED = (
    "array<struct<name string, type string, mode string, title string, description string, "
    "examples string, fields string, children string>>"
)
# objects hold theirs in ``properties``, by name; of an array the ``items`` count
_OBJECT = "struct<properties map<string, string>, items string>"
_PROPERTY = (
    "struct<type string, mode string, title string, description string, examples string, "
    "properties string, items string>"
)


def _entry(name: Column, f: Column, kind: Column, mode: Column, inner: Column) -> Column:
    return F.struct(
        name.alias("name"),
        kind.alias("type"),
        mode.alias("mode"),
        f["title"].alias("title"),
        f["description"].alias("description"),
        f["examples"].alias("examples"),
        inner.alias("inner"),
    )


def _listed(f: Column) -> Column:
    return _entry(f["name"], f, f["type"], f["mode"], F.coalesce(f["fields"], f["children"]))


def _property(name: Column, text: Column) -> Column:
    f = F.from_json(text, _PROPERTY)
    item = F.from_json(f["items"], _PROPERTY)
    of_items = F.coalesce(item["properties"], item["items"]).isNotNull()
    inner = F.when(f["properties"].isNotNull(), text).when(of_items, f["items"])
    kind = F.when(inner.isNotNull(), F.lit("RECORD")).otherwise(F.coalesce(item["type"], f["type"]))
    mode = F.when(f["items"].isNotNull(), F.lit("REPEATED")).otherwise(f["mode"])
    return _entry(name, f, kind, mode, inner)


def _entries(text: str) -> Column:
    """Fields of one level: of a list, or of an object or the items of an array."""
    whole = F.from_json(text, _OBJECT)
    items = F.from_json(whole["items"], _OBJECT)
    properties = F.map_entries(F.coalesce(whole["properties"], items["properties"]))
    return F.when(
        F.startswith(F.ltrim(text), F.lit("[")), F.transform(F.from_json(text, _LISTED), _listed)
    ).otherwise(F.transform(properties, lambda p: _property(p["key"], p["value"])))


def malformed_schemas(docs: DataFrame, doc: str = "doc", fields: str = "fields") -> DataFrame:
    """Documents of which ``flatten_schema`` can read nothing: no JSON, or no fields in it."""
    found = F.coalesce(F.size(_entries(fields)), F.lit(0))
    broken = F.expr(f"try_parse_json(`{fields}`)").isNull()
    reason = F.when(broken, F.lit("not JSON")).when(found == 0, F.lit("no fields"))
    return docs.select(doc, reason.alias("reason")).where("reason is not null")


def flatten_schema(docs: DataFrame, doc: str = "doc", fields: str = "fields") -> DataFrame:
    """One row per field of each schema document, numbered in pre-order.

    ``fields`` is JSON text: a list of fields with inner ``fields`` or ``children``, or an object
    with ``properties`` (in ``items`` for arrays); the latter give the type RECORD where there
    are inner fields, and the mode REPEATED for arrays. Each round takes the fields of one level;
    inner ones stay text until their turn, so any depth works. ``malformed_schemas`` names the
    documents that give no row.
    """
    level = docs.select(
        doc,
        F.lit(None).cast("string").alias("parent"),
        F.array().cast("array<int>").alias("place"),
        F.col(fields).alias("_inner"),
    )
    found, at = None, 0
    while True:
        at += 1
        rows = level.select(
            doc, "parent", "place", F.posexplode(_entries("_inner")).alias("_pos", "f")
        ).select(
            doc,
            "parent",
            F.concat_ws(".", "parent", "f.name").alias("path"),
            F.concat("place", F.array("_pos")).alias("place"),
            F.col("f.name").alias("name"),
            F.col("f.type").alias("type"),
            F.col("f.mode").alias("mode"),
            F.col("f.title").alias("title"),
            F.col("f.description").alias("description"),
            F.col("f.examples").alias("examples"),
            F.col("f.inner").isNull().alias("is_leaf"),
            F.lit(at).alias("level"),
            F.col("f.inner").alias("_inner"),
        )
        rows = hand_over(rows, "schema-level")
        found = rows if found is None else found.unionByName(rows)
        level = rows.where("not is_leaf").select(
            doc, F.col("path").alias("parent"), "place", "_inner"
        )
        if level.isEmpty():
            break
    return number_in_groups(found.drop("_inner"), [doc], ["place"], "seq").drop("place")


def _quoted(text: Column) -> Column:
    """JSON text of a string."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def encode_schema(rows: DataFrame, doc: str = "doc") -> DataFrame:
    """Schema document per ``doc`` from the rows of ``flatten_schema``, which can read it again.

    Works from the deepest level up: the texts of the children of one parent are joined in
    order of their names. Repeated fields become arrays. A document is one text in the end, so
    its fields meet in one row; there are no larger groups than documents.
    """
    wanted = ["parent", "path", "name", "type", "mode", "title", "description", "examples"]
    open_rows = hand_over(rows.select(doc, *wanted, "is_leaf", "level"), "schema-rows")
    depth = open_rows.agg(F.max("level")).first()[0] or 0
    entry = F.struct("name", "json")

    def members(items: str) -> Column:
        texts = F.transform(
            F.sort_array(items),
            lambda e: F.concat(_quoted(e["name"]), F.lit(":"), e["json"]),
        )
        return F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}"))

    def attributes(*names: str) -> Column:
        """The members that a field has, without the braces; examples are JSON already."""
        texts = [
            F.when(
                F.col(n).isNotNull(),
                F.concat(F.lit(f'"{n}":'), F.col(n) if n == "examples" else _quoted(F.col(n))),
            )
            for n in names
        ]
        return F.array_join(F.array_compact(F.array(*texts)), ",")

    repeated = F.coalesce(F.upper("mode") == "REPEATED", F.lit(False))
    about = attributes("title", "description", "examples")
    about = F.when(about != "", F.concat(F.lit(","), about)).otherwise(F.lit(""))
    below = None
    for at in range(depth, 0, -1):
        here = open_rows.where(F.col("level") == at)
        if below is None:
            here = here.withColumn("_properties", F.lit("{}"))
        else:
            here = here.join(below, [doc, "path"], "left")
        inner = F.coalesce("_properties", F.lit("{}"))
        leaf = F.concat(F.lit("{"), attributes("type", "title", "description", "examples"), F.lit("}"))
        item = F.concat(F.lit("{"), attributes("type"), F.lit("}"))
        obj = F.concat(F.lit('{"type":"object","properties":'), inner, about, F.lit("}"))
        arr = F.concat(F.lit('{"type":"array","items":{"properties":'), inner, F.lit("}"), about, F.lit("}"))
        leaves = F.concat(F.lit('{"type":"array","items":'), item, about, F.lit("}"))
        text = (
            F.when(F.col("is_leaf") & repeated, leaves)
            .when(F.col("is_leaf"), leaf)
            .when(repeated, arr)
            .otherwise(obj)
        )
        built = here.select(doc, "parent", "name", text.alias("json"))
        group = [doc, "parent"] if at > 1 else [doc]
        below = built.groupBy(*group).agg(F.collect_list(entry).alias("_items"))
        below = below.withColumn("_properties", members("_items")).drop("_items")
        if at > 1:
            below = below.withColumnRenamed("parent", "path")
    if below is None:
        below = open_rows.select(doc, F.lit("{}").alias("_properties"))
    return below.select(
        doc, F.concat(F.lit('{"type":"object","properties":'), "_properties", F.lit("}")).alias("json")
    )
