"""Custom-field values: long and wide form, tags and picker fields."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.aggregates import dedup_keep
from shelfmark.operators.quality import value_counts
from shelfmark.session import hand_over
from shelfmark.skew import joined_lists, lookup_join

OBJECT_SET, MULTI_PICKER = "OBJECT_SET", "MULTI_PICKER"


def pivot_attrs(
    values: DataFrame, fields: DataFrame, known: Sequence[str], size: int = 10_000
) -> DataFrame:
    """Field values as one wide row per object.

    ``values`` has (otype, id, field_id, ord, value, value_otype), ``fields`` (field_id, name,
    field_type). Values of an object set go to the column ``name:otype``, joined by ``;`` in
    parts of ``size``; of other fields the last value counts. ``known`` are the columns wanted.
    """
    named = values.join(fields, "field_id").withColumn(
        "key",
        F.when(
            F.col("field_type") == OBJECT_SET,
            F.concat(F.lower("name"), F.lit(":"), "value_otype"),
        ).otherwise(F.lower("name")),
    )
    sets = joined_lists(
        named.where(F.col("field_type") == OBJECT_SET),
        ["otype", "id", "key"], ["ord", "value"], F.col("value"), size, "items",
    ).select("otype", "id", "part", "key", F.array_join("items", ";").alias("value"))
    single = dedup_keep(
        named.where(F.col("field_type") != OBJECT_SET), ["otype", "id", "key"], ["ord"], "last"
    ).select("otype", "id", F.lit(0).alias("part"), "key", "value")
    return (
        sets.unionByName(single)
        .groupBy("otype", "id", "part")
        .pivot("key", list(known))
        .agg(F.min("value"))
    )


def unpivot_attrs(
    wide: DataFrame, fields: DataFrame, keys: Sequence[str] = ("otype", "id"),
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Wide rows as one row per object and field, with an array of values.

    ``fields`` has (field_id, name, field_type, options, allowed_otypes). Headers are ``field``
    or ``field:otype``, compared without case; headers without a field are ignored. An object
    set is split at ``;`` if its type is allowed, a multi-picker keeps the options that occur,
    and headers of one field are merged.
    """
    headers = [c for c in wide.columns if c not in keys]
    parsed = wide.sparkSession.createDataFrame(
        [
            (i, h, h.split(":")[0].lower(), h.split(":")[1] if ":" in h else None)
            for i, h in enumerate(headers)
        ],
        "header_no int, header string, _name string, value_otype string",
    )
    registry = dedup_keep(
        fields.withColumn("_name", F.lower("name")), ["_name"], ["field_id"]
    ).drop("name")
    # one row per header of the wide table at most
    known = F.broadcast(parsed.join(registry, "_name").drop("_name"))
    long = wide.unpivot(
        list(keys), [F.col(f"`{h}`").cast("string").alias(h) for h in headers], "header", "text"
    ).where("text is not null")
    options = F.filter("options", lambda option: F.contains(F.col("text"), option))
    allowed = F.array_contains("allowed_otypes", F.col("value_otype"))
    items = (
        F.when(F.col("field_type") == MULTI_PICKER, options)
        .when((F.col("field_type") == OBJECT_SET) & allowed, F.split("text", ";"))
        .when(F.col("field_type") != OBJECT_SET, F.array("text"))
    )
    valued = long.join(known, "header").withColumn("items", items).where("size(items) > 0")
    return (
        valued.groupBy(*keys, "field_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("header_no", "value_otype", "items"))
            ).alias("_all")
        )
        .select(
            *keys,
            "field_id",
            F.flatten(
                F.transform(
                    "_all",
                    lambda h: F.transform(
                        h["items"],
                        lambda v: F.struct(h["value_otype"].alias("otype"), v.alias("value")),
                    ),
                )
            ).alias("values"),
            F.lit(as_of).cast("timestamp").alias("ts_updated"),
        )
    )


def resolve_object_sets(
    long: DataFrame, objects: DataFrame, keys: Sequence[str] = ("otype", "id")
) -> tuple[DataFrame, DataFrame]:
    """Values of ``unpivot_attrs`` with the ids of the objects they name, and those not found.

    ``objects`` has (otype, name, oid); names are compared without case, and of several objects
    of one name the lowest id counts. Items without a type, as of pickers, stay as they are. The
    first table has ``values`` of (otype, value, oid) without the items that name no object; a
    value of none but such items is left out. The second has a row per item not found.
    """
    rows = [*keys, "field_id"]
    items = long.select(*rows, "ts_updated", F.posexplode("values").alias("pos", "v")).select(
        *rows, "ts_updated", "pos", F.col("v.otype").alias("_otype"), F.col("v.value").alias("value"),
        F.lower(F.trim("v.value")).alias("_name"),
    )
    dim = objects.groupBy(
        F.col("otype").alias("_otype"), F.lower(F.trim("name")).alias("_name")
    ).agg(F.min("oid").alias("oid"))
    named = hand_over(lookup_join(items, dim, ["_otype", "_name"]), "object-sets")
    lost = F.col("_otype").isNotNull() & F.col("oid").isNull()
    value = F.struct("pos", F.col("_otype").alias("otype"), "value", "oid")
    found = (
        named.where(~lost)
        .groupBy(*rows)
        .agg(F.sort_array(F.collect_list(value)).alias("_all"), F.first("ts_updated").alias("ts_updated"))
        .select(*rows, F.transform("_all", lambda v: v.dropFields("pos")).alias("values"), "ts_updated")
    )
    unresolved = named.where(lost).select(*rows, F.col("_otype").alias("value_otype"), "value")
    return found, unresolved


def explode_tags(df: DataFrame, keys: Sequence[str], tags: str, sep: str = ";") -> DataFrame:
    """(object, tag) rows of a tag list; blank tags are dropped."""
    parts = F.array_distinct(F.split(tags, "\\Q" + sep + "\\E"))
    return df.select(*keys, F.explode(parts).alias("tag")).where("tag <> ''")


def picker_fields(
    df: DataFrame, cols: Sequence[str], lo: int = 20, hi: int = 120, prefix: str = ""
) -> DataFrame:
    """A picker field per column with more than ``lo`` and at most ``hi`` values, with its options."""
    name: Column = F.substring(F.concat(F.lit(prefix), "col"), 1, 25)
    return (
        value_counts(df, cols, lo, hi)
        .groupBy("col")
        .agg(F.sort_array(F.collect_list("value")).alias("options"))
        .select("col", name.alias("name"), F.lit("PICKER").alias("field_type"), "options")
    )
