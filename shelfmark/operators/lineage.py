"""Lineage paths, edges and the tables they touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import hash_id
from shelfmark.operators.lookups import unique_lookup
from shelfmark.session import hand_over
from shelfmark.skew import lookup_join


def _starts(first_only: bool = False) -> Column:
    """Places in ``path`` where a source, a dataflow and a target follow each other.

    None for a shorter path; a filter would compute the path a second time.
    """
    last = F.lit(0) if first_only else F.size("path") - 3
    return F.when(F.size("path") >= 3, F.sequence(F.lit(0), last, F.lit(2)))


def lineage_edges(
    paths: DataFrame, legacy_three_hop: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Edges from each source to its dataflow and from there to each target, along all paths.

    ``paths`` has the column ``path``: an array of hops, each an array of (otype, key,
    is_temp); every second hop holds the dataflow, which also comes as a column of its own, as
    do the columns ``carry``. With ``legacy_three_hop`` only the first three hops are read. A
    dataflow of many sources and targets has one row for each of them, not for each pair. Rows
    are made within a path, so nothing is shuffled before the final distinct.
    """
    starts = paths.select(*carry, "path", F.explode(_starts(legacy_three_hop)).alias("i"))
    flow = F.get(F.col("path")[F.col("i") + 1], F.lit(0))

    def side(goes_in: bool, hop: Column) -> Column:
        return F.struct(F.lit(goes_in).alias("goes_in"), hop.alias("hop"))

    i = F.col("i")
    both = F.array(side(True, F.col("path")[i]), side(False, F.col("path")[i + 2]))
    sides = starts.select(*carry, flow["key"].alias("dataflow"), F.explode(both).alias("s"))
    ends = sides.select(*carry, "dataflow", "s.goes_in", F.explode("s.hop").alias("e"))
    # an edge is told by its end and its dataflow, so each text is in the key of the distinct once
    found = ends.select(*carry, "dataflow", "goes_in", "e.otype", "e.key").distinct()
    flow_type, goes_in = F.lit("dataflow"), F.col("goes_in")
    return found.select(
        *carry,
        "dataflow",
        F.when(goes_in, F.col("otype")).otherwise(flow_type).alias("src_otype"),
        F.when(goes_in, F.col("key")).otherwise(F.col("dataflow")).alias("src"),
        F.when(goes_in, flow_type).otherwise(F.col("otype")).alias("dst_otype"),
        F.when(goes_in, F.col("dataflow")).otherwise(F.col("key")).alias("dst"),
    )


def tables_with_lineage(dataflows: DataFrame, titles: DataFrame) -> DataFrame:
    """One row per table and dataflow it goes in or out of; temporary tables are left out.

    ``dataflows`` has the column ``path``, ``titles`` the columns ``dataflow`` and ``title``.
    """
    starts = dataflows.select("path", F.explode(_starts()).alias("i"))
    ends = starts.select(
        F.get(F.col("path")[F.col("i") + 1], F.lit(0))["key"].alias("dataflow"),
        F.explode(
            F.concat(
                F.transform(F.col("path")[F.col("i")], lambda e: F.struct(F.lit("in").alias("side"), e.alias("e"))),
                F.transform(F.col("path")[F.col("i") + 2], lambda e: F.struct(F.lit("out").alias("side"), e.alias("e"))),
            )
        ).alias("end"),
    )
    tables = (
        ends.where("end.e.otype = 'table' and not coalesce(end.e.is_temp, false)")
        .select(F.col("end.e.key").alias("key"), F.col("end.side").alias("side"), "dataflow")
        .distinct()
    )
    return lookup_join(tables, titles.select("dataflow", "title"), "dataflow")


def lineage_from_mapping(
    mapping: DataFrame, catalog: DataFrame, source: str = "source_table", target: str = "target_table"
) -> tuple[DataFrame, DataFrame]:
    """Table pairs of a column mapping sheet as dataflows, and the pairs with an unknown side.

    ``catalog`` has ``name`` and ``key``. The dataflow id is a hash of the pair.
    """
    pairs = (
        mapping.select(F.col(source).alias("src_name"), F.col(target).alias("dst_name"))
        .dropna()
        .distinct()
    )
    for side in ("src", "dst"):
        dim = catalog.select(F.col("name").alias(f"{side}_name"), F.col("key").alias(f"{side}_key"))
        pairs = unique_lookup(pairs, dim, f"{side}_name", f"{side}_key")
    pairs = hand_over(pairs, "pairs")
    known = "src_key is not null and dst_key is not null"
    edges = pairs.where(known).select(
        F.col("src_key").alias("src"),
        F.concat(F.lit("api/"), hash_id(F.concat("src_key", F.lit(">"), "dst_key"))).alias("dataflow"),
        F.col("dst_key").alias("dst"),
        F.concat(F.lit("Dataflow from "), "src_name", F.lit(" to "), "dst_name").alias("description"),
    )
    unresolved = pairs.where(f"not ({known})").select(
        "src_name",
        "dst_name",
        F.when(F.col("src_key").isNull(), F.lit("source")).otherwise(F.lit("target")).alias("missing"),
    )
    return edges, unresolved


def flagged_field_lineage(
    fields: DataFrame, flag: str, key: str, source_key: str, mark: object = "x"
) -> DataFrame:
    """Path external -> dataflow -> column for every flagged field with a key.

    The dataflow id is made from the source and the field's key.
    """
    flow = F.concat(F.lit(f"api/{source_key}-"), hash_id(F.col(key).cast("string")))

    def hop(otype: str, value) -> object:
        return F.array(
            F.struct(
                F.lit(otype).alias("otype"),
                value.cast("string").alias("key"),
                F.lit(False).alias("is_temp"),
            )
        )

    return fields.where((F.col(flag) == mark) & F.col(key).isNotNull()).select(
        flow.alias("dataflow"),
        F.array(
            hop("external", F.lit(source_key)), hop("dataflow", flow), hop("column", F.col(key))
        ).alias("path"),
    )
