"""Grouped and whole-table aggregates. All combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.skew import joined_lists, lookup_join, number_in_groups


def count_by(df: DataFrame, keys: Sequence[str], scale: float = 1) -> DataFrame:
    """Rows per key, most frequent first; with ``scale`` as a fraction, e.g. 1e6 for millions."""
    n = F.count("*")
    counts = df.groupBy(*keys).agg((n if scale == 1 else n / F.lit(scale)).alias("count"))
    return counts.orderBy(F.desc("count"), *keys)


def count_null(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(column).isNull()).alias("nulls"), F.count(column).alias("filled")
    )


def distinct_days(df: DataFrame, ts: str) -> DataFrame:
    """Number of days with data; days are made distinct before they are counted."""
    return df.agg(F.count_distinct(F.date_trunc("day", ts)).alias("days"))


def term_counts(
    df: DataFrame, text: str, pattern: str = r"[\W0-9]", drop_empty: bool = False
) -> DataFrame:
    """Occurrences of each lower-case term, most frequent first.

    Terms are counted on the map side; only the counts are shuffled and sorted. The empty text between neighbouring separators counts as a term unless dropped.
    """
    terms = F.split(F.lower(text), pattern)
    if drop_empty:
        terms = F.array_remove(terms, "")
    return (
        df.select(F.explode(terms).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "term")
    )


def dir_rollup(files: DataFrame, keys: Sequence[str], min_files: int = 2) -> DataFrame:
    """File count and megabytes of folders with more than ``min_files`` files."""
    return (
        files.where("size > 0")
        .groupBy(*keys)
        .agg(F.count("*").alias("files"), (F.sum("size") / F.lit(1 << 20)).alias("mb"))
        .where(F.col("files") > min_files)
    )


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def duplicate_keys(
    df: DataFrame,
    cols: Sequence[str],
    keep: str | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keys that occur twice or more, with their count.

    With ``keep="first"`` the rows themselves, all but the first of each key by ``order``.
    """
    if keep is None:
        counted = df.groupBy(*cols).agg(F.count("*").alias("n"))
        return counted.where("n > 1")
    return number_in_groups(df, cols, order or df.columns, "_rn").where("_rn > 1").drop("_rn")


def string_agg(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    sep: str,
    order: Sequence[str | Column],
    size: int = 10_000,
) -> DataFrame:
    """Ordered text list per group, in parts of ``size`` values."""
    lists = joined_lists(df, keys, order, F.col(column).cast("string"), size, column)
    return lists.withColumn(column, F.array_join(column, sep))


def collect_children(
    df: DataFrame, parent: str, child: str, size: int = 10_000
) -> DataFrame:
    """Sorted child ids per parent, in parts of ``size`` ids."""
    return joined_lists(df, [parent], [child], F.col(child), size, "children")


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def recent_n_blocks(df: DataFrame, number: str, n: int, key: str) -> DataFrame:
    """Rows per key among the rows numbered no lower than the highest number minus ``n``."""
    highest = df.agg(F.max(number)).scalar()
    return df.where(F.col(number) >= highest - n).groupBy(key).agg(F.count("*").alias("count"))


def first_per_group(
    df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str]
) -> DataFrame:
    """Value of the first row of each group."""
    return df.groupBy(*keys).agg(F.min_by(column, F.struct(*order)).alias(column))


def message_frequency(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """How often each captured text occurs; rows without a match are left out."""
    found = F.regexp_extract(text, pattern, 1)
    return (
        df.select(found.alias("capture"))
        .where("capture <> ''")
        .groupBy("capture")
        .agg(F.count("*").alias("count"))
    )


def group_members(users: DataFrame) -> DataFrame:
    """(user, group) pairs of nested memberships, without built-in groups."""
    return (
        users.select("user", F.explode("groups").alias("g"))
        .where("not g.is_builtin")
        .select("user", F.col("g.name").alias("group"))
        .distinct()
    )


def load_summary(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Job results as counts per status, and the key -> id mapping they report."""
    mapping = results.select(F.explode("result").alias("r")).select(
        F.explode("r.mapping").alias("m")
    )
    counts = results.groupBy("status").agg(
        F.count("*").alias("jobs"),
        F.sum(
            F.aggregate("result", F.lit(0), lambda n, r: n + F.coalesce(F.size(r["mapping"]), F.lit(0)))
        ).alias("mapped"),
        F.sum(
            F.aggregate("result", F.lit(0), lambda n, r: n + F.coalesce(F.size(r["errors"]), F.lit(0)))
        ).alias("errors"),
    )
    return counts, mapping.select("m.key", "m.id")


def thread_root(df: DataFrame, thread: str, order: str) -> DataFrame:
    """Give every post the number of the first post and the size of its thread.

    Root and size come from an aggregate, added up where the posts are read, and are joined back by a
    join that adaptive execution can split, so a long thread is not gathered in one task.
    """
    roots = df.groupBy(thread).agg(F.min(order).alias("root"), F.count("*").alias("thread_size"))
    return lookup_join(df, roots, thread)


def position_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    return number_in_groups(df, keys, order, name)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int
) -> DataFrame:
    """First ``n`` rows of each group, with their ``rank``.

    The filter on the row number limits each input partition to ``n`` rows per group before
    the shuffle; Spark does so for ``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``,
    which ``build_session`` raises.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = df.withColumn("rank", rank).where(F.col("rank") <= n)
    return first.withColumn("rank", F.col("rank").cast("bigint"))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The row with the highest ``order`` of each key."""
    return top_n_per_group(df, keys, [F.desc(o) for o in order], 1).drop("rank")


def dedup_keep(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first"
) -> DataFrame:
    direction = F.asc if keep == "first" else F.desc
    return top_n_per_group(df, keys, [direction(o) for o in order], 1).drop("rank")
