"""Joins and lookups between objects and the tables that describe them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import hand_over
from shelfmark.skew import joined_lists, lookup_join, number_rows


def left_join_attrs(
    objects: DataFrame, attrs: DataFrame, on: Sequence[str] = ("otype", "id")
) -> DataFrame:
    """All objects with their attribute values where there are any."""
    return objects.join(attrs, list(on), "left")


def catalog_export(
    ds: DataFrame, schema: DataFrame, table: DataFrame, attribute: DataFrame
) -> DataFrame:
    """Columns of the catalog with table, schema and source; excluded and deleted ones left out.

    The filters sit on the inputs; schemas name their source, so three joins do. The sort ends
    with the unique attribute id.
    """
    sources = ds.where("not deleted").select("ds_id", "ds_title", "ds_type")
    schemas = schema.where("not excluded").select("schema_id", "schema_name", "ds_id")
    tables = table.where("not excluded").select("table_id", "table_name", "schema_id")
    columns = attribute.where("not excluded").drop("excluded")
    return (
        columns.join(tables, "table_id")
        .join(schemas, "schema_id")
        .join(sources, "ds_id")
        .orderBy("ds_id", "schema_id", "table_id", "position", "attribute_id")
    )


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with a match; the keys of ``right`` are made distinct before the join."""
    return lookup_join(left, right.select(*on).distinct(), list(on), "left_semi")


def new_only(
    candidates: DataFrame, existing: DataFrame, on: str, ignore_case: bool = False
) -> DataFrame:
    """Candidates whose key is not there yet."""
    key = F.lower(on) if ignore_case else F.col(on)
    known = existing.select(key.alias("_key")).distinct()
    return lookup_join(candidates.withColumn("_key", key), known, "_key", "left_anti").drop("_key")


def unique_lookup(df: DataFrame, dim: DataFrame, on: str, value: str) -> DataFrame:
    """Add ``value`` where exactly one row of ``dim`` matches, else null."""
    single = (
        dim.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count("*").alias("_n"), F.min(value).alias(value))
        .where("_n = 1")
        .drop("_n")
    )
    return lookup_join(df, single, on)


def policy_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    value: str,
    order: str,
    pick: str = "first",
) -> DataFrame:
    """Add ``value`` of the first or last match by ``order``."""
    best = F.min_by if pick == "first" else F.max_by
    chosen = dim.where(F.col(on).isNotNull()).groupBy(on).agg(best(value, order).alias(value))
    return lookup_join(df, chosen, on)


def id_remap(df: DataFrame, src_dim: DataFrame, dst_dim: DataFrame, bridge: str) -> DataFrame:
    """Old id -> ``bridge`` value on the source -> new id on the target.

    Ids and ``bridge`` values found twice give no new id.
    """
    with_bridge = unique_lookup(df, src_dim.select("old_id", bridge), "old_id", bridge)
    return unique_lookup(with_bridge, dst_dim.select(bridge, "new_id"), bridge, "new_id")


def offset_ids(df: DataFrame, order: Sequence[str | Column], offset: int) -> DataFrame:
    """Consecutive new ids after ``offset``."""
    return number_rows(df, order, "new_id").withColumn("new_id", F.col("new_id") + offset)


def mapping_join(df: DataFrame, mapping: Mapping[str, tuple], on: str, names: Sequence[str]) -> DataFrame:
    """Add the values that a literal mapping holds for ``on``; rows without an entry drop out."""
    rows = [(key, *entry) for key, entry in mapping.items()]
    literal = df.sparkSession.createDataFrame(rows, [on, *names])
    return df.join(F.broadcast(literal), on)


def bidirectional_lookup(dim: DataFrame, key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Key -> name and name -> key; of a repeated name the smallest key is kept."""
    forward = dim.groupBy(key).agg(F.min(name).alias(name))
    backward = dim.groupBy(name).agg(F.min(key).alias(key))
    return forward, backward


def look_up_name(df: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Add the name of a key, ``unknown`` where there is none."""
    return lookup_join(df, names, key).withColumn(name, F.coalesce(name, F.lit("unknown")))


def membership_resolve(members: DataFrame, users: DataFrame, size: int = 10_000) -> DataFrame:
    """Per group the ids of its known users, in parts of ``size``, and the count of unknown ones."""
    dim = users.groupBy("user").agg(F.min("user_id").alias("user_id"))
    wanted = members.select("group", "user").distinct()
    found = hand_over(lookup_join(wanted, dim, "user"), "members")
    known = found.where("user_id is not null")
    lists = joined_lists(known, ["group"], ["user_id"], F.col("user_id"), size, "user_ids")
    unknown = found.groupBy("group").agg(F.count_if(F.col("user_id").isNull()).alias("unknown"))
    return unknown.join(lists, "group", "left").withColumn("part", F.coalesce("part", F.lit(0)))


def merge_on_key(logical: DataFrame, physical: DataFrame, on: str = "path") -> DataFrame:
    """Inner join on the full path."""
    return logical.join(physical, on)


def array_lookup(
    df: DataFrame, row_id: str, array: str, dim: DataFrame, key: str, title: str
) -> DataFrame:
    """Titles of the ids in an array, in its order; unknown ids are left out.

    The lists built are no longer than the arrays they come from.
    """
    items = df.select(row_id, F.posexplode(array).alias("_pos", key))
    titled = lookup_join(items, dim.select(key, title), key, "inner")
    lists = titled.groupBy(row_id).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_pos", title))), lambda i: i[title]
        ).alias(title)
    )
    return df.join(lists, row_id, "left")
