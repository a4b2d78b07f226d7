"""Row numbering and lookups that hold when one key has a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import hand_over

_RANGE, _MID = "_range", "_mid"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the position in its low 33 bits


def as_columns(order: Sequence[str | Column] | str | Column) -> list[Column]:
    if isinstance(order, str | Column):
        order = [order]
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _place(df: DataFrame, order: list[Column]) -> DataFrame:
    """Sort by range and keep for each row its range and its place in it."""
    placed = hand_over(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_MID, F.monotonically_increasing_id()),
        "numbered",
    )
    return placed.withColumn(_RANGE, F.shiftright(_MID, _POSITION_BITS))


def place_rows(df: DataFrame, order: Sequence[str | Column], ranges: int) -> DataFrame:
    """Rows sorted into about ``ranges`` ranges, equal keys in one, with the number of the range
    (``_range``) and the place in it (``_place``, from 0). Written once.
    """
    by = as_columns(order)
    placed = hand_over(
        df.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn(_MID, F.monotonically_increasing_id()),
        "placed",
    )
    return placed.select(
        *df.columns,
        F.shiftright(_MID, _POSITION_BITS).alias("_range"),
        F.col(_MID).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_place"),
    )


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """Add the 1-based row number over the whole table in ``order``.

    No window runs over the table: rows are range partitioned, and only the row count of each
    range (one row per partition) is summed up and broadcast. End ``order`` with a unique key
    for a repeatable result; it also lets a hot value be cut over several ranges.
    """
    placed = _place(df, as_columns(order))
    sizes = placed.groupBy(_RANGE).agg(F.count("*").alias("_size"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _RANGE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col(_MID).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), _RANGE)
        .withColumn(name, F.col("_offset") + position + 1)
        .drop(_RANGE, _MID, "_offset")
    )


# groups of fewer rows are never worth cutting
SPLIT_ROWS = 10_000


def crowded(df: DataFrame, keys: Sequence[str]) -> list[Row]:
    """Groups with more rows than half a shuffle partition should hold.

    Rows are counted on the map side first. No more than two groups per shuffle partition can
    have that many rows, whatever the size of the table, so the list is short.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    share = counted.agg(F.sum("_n") / F.lit(partitions)).scalar()
    return (
        counted.where((F.col("_n") * 2 > share) & (F.col("_n") >= SPLIT_ROWS))
        .select(*keys)
        .collect()
    )


def _table_of(groups: list[Row], df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The crowded groups as a table, short enough to be broadcast."""
    fields = [T.StructField(f"_g_{k}", df.schema[k].dataType) for k in keys]
    return df.sparkSession.createDataFrame(groups, T.StructType(fields))


def number_in_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rn"
) -> DataFrame:
    """Add the 1-based row number within each group, whatever the size of a group.

    A window numbers the groups that fit a task. The rows of crowded groups, if there are any,
    are range partitioned by group and order instead, so that a group may span many tasks.
    """
    keys = list(keys)
    order = as_columns(order)
    in_group = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    groups = crowded(df, keys)
    if not groups:
        return df.withColumn(name, in_group.cast("bigint"))
    large = _table_of(groups, df, keys)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    few = df.join(F.broadcast(large), same, "left_anti").withColumn(name, in_group.cast("bigint"))
    many = df.join(F.broadcast(large), same, "left_semi")
    return few.unionByName(_number_over_ranges(many, keys, order, name))


def _number_over_ranges(
    df: DataFrame, keys: list[str], order: list[Column], name: str
) -> DataFrame:
    """Numbers are given per (range, group); a group that goes on from earlier ranges gets the
    count so far. At most one group goes on into a range, so the table of those counts has no
    more rows than there are ranges and is broadcast.
    """
    placed = _place(df, [*map(F.col, keys), *order])
    local = Window.partitionBy(_RANGE, *keys).orderBy(_MID)
    runs = placed.groupBy(_RANGE, *keys).agg(F.count("*").alias("_size"))
    earlier = (
        Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        runs.withColumn("_carry", F.sum("_size").over(earlier))
        .where("_carry is not null")
        .select(
            F.col(_RANGE).alias("_c_range"),
            "_carry",
            *[F.col(k).alias(f"_c_{k}") for k in keys],
        )
    )
    same = F.col(_RANGE) == F.col("_c_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return (
        placed.withColumn("_local", F.row_number().over(local))
        .join(F.broadcast(carried), same, "left")
        .withColumn(name, F.col("_local") + F.coalesce("_carry", F.lit(0)))
        .select(*df.columns, name)
    )


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "left"
) -> DataFrame:
    """Equi-join for a ``left`` side that may have hot keys: inner, left, semi or anti.

    A ``right`` side that Spark broadcasts by its size needs no shuffle. Else adaptive execution
    splits the rows of a hot key, null among them, over several tasks, which it can do for the
    left side of these joins as long as nothing above needs the key's rows together.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how}: the left side of this join cannot be split")
    return left.join(right, [on] if isinstance(on, str) else list(on), how)


def joined_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: Column,
    size: int,
    name: str,
) -> DataFrame:
    """Ordered list of ``value`` per group, cut in parts of ``size`` values.

    A group of any size gives as many rows (``part`` 0, 1, ...) as it needs.
    """
    numbered = number_in_groups(df, keys, order, "_rn").withColumn(
        "part", F.floor((F.col("_rn") - 1) / size).cast("int")
    )
    return (
        numbered.groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(F.struct("_rn", value.alias("v")))).alias("_items"))
        .withColumn(name, F.transform("_items", lambda item: item["v"]))
        .drop("_items")
    )
