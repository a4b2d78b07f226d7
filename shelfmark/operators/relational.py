"""Projections, filters, sorts and set operations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import text, values
from shelfmark.operators.paging import PageIndex
from shelfmark.skew import as_columns, number_rows


def nested_project(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Columns by dotted path: alias -> path."""
    return df.select(*[F.col(path).alias(alias) for alias, path in paths.items()])


def _has_path(schema: T.DataType, path: Sequence[str]) -> bool:
    if not path:
        return True
    if isinstance(schema, T.ArrayType):
        return _has_path(schema.elementType, path)
    if not isinstance(schema, T.StructType) or path[0] not in schema.fieldNames():
        return False
    return _has_path(schema[path[0]].dataType, path[1:])


def select_existing(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that the schema has, and the names of those it lacks."""
    found = [w for w in wanted if _has_path(df.schema, w.split("."))]
    return df.select(*found), [w for w in wanted if w not in found]


def filter_predicates(df: DataFrame, *conditions: Column | str) -> DataFrame:
    """Rows for which all conditions hold."""
    return reduce(lambda kept, condition: kept.where(condition), conditions, df)


def token_search(
    df: DataFrame,
    column: str,
    query: str,
    otypes: Sequence[str] | None = None,
    otype_col: str = "otype",
    mode: str = "any",
) -> DataFrame:
    """Rows whose text has any (or all) words of the query, of the given object types."""
    if otypes:
        df = df.where(F.col(otype_col).isin(*otypes))
    words = sorted({w.lower() for w in query.split()})
    found = text.tokens(column)
    if mode == "any":
        return df.where(F.arrays_overlap(found, F.array(*map(F.lit, words))))
    return df.where(reduce(Column.__and__, [F.array_contains(found, w) for w in words]))


def rename_drop(
    df: DataFrame,
    rename: Mapping[str, str],
    keep: Sequence[str] | None = None,
    drop: Sequence[str] | None = None,
) -> DataFrame:
    """Rename by mapping, then keep or drop columns by their new names."""
    df = df.withColumnsRenamed(dict(rename))
    if drop:
        df = df.drop(*drop)
    return df.select(*keep) if keep else df


def coerce_clean(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Clean columns in place: column -> int, float, text or report_type."""
    return df.withColumns({c: values.RULES[rule](F.col(c)) for c, rule in rules.items()})


def fill_defaults(
    df: DataFrame, defaults: Mapping[str, object], as_of: dt.datetime | None = None
) -> DataFrame:
    """Replace nulls by a value or another column's value.

    In a date or timestamp column ``now`` stands for ``as_of``, or the time of the run.
    """

    def default(column: str, value: object) -> Column:
        if isinstance(value, Column):
            return value
        if value == "now" and df.schema[column].dataType.typeName() in ("date", "timestamp"):
            return F.current_timestamp() if as_of is None else F.lit(as_of)
        return F.lit(value)

    return df.withColumns({c: F.coalesce(F.col(c), default(c, v)) for c, v in defaults.items()})


def prune_empty(df: DataFrame, cols: Sequence[str], how: str = "all") -> DataFrame:
    """Drop rows where all (or any) of the columns are null."""
    return df.dropna(how=how, subset=list(cols))


def sort_keys(df: DataFrame, *order: str | Column) -> DataFrame:
    """Global sort; end with a unique key so that a hot value can be cut over ranges."""
    return df.orderBy(*order)


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps no more than ``k``."""
    return df.orderBy(*as_columns(order)).limit(k)


def page_slice(
    df: DataFrame, order: Sequence[str | Column], limit: int, offset: int = 0
) -> DataFrame:
    """Page of a sorted result, in its order.

    Ordered by names of columns (``-`` in front for falling order), only the key columns are sorted
    and only rows of the page's key ranges are read whole; for many pages of one result make a
    ``PageIndex`` and keep it. Ordered by expressions, rows are numbered.
    """
    if all(isinstance(o, str) for o in order):
        return PageIndex(df, order).page(limit, offset)
    numbered = number_rows(df, order, "_rn")
    page = numbered.where(F.col("_rn").between(offset + 1, offset + limit))
    return page.orderBy("_rn").drop("_rn")


def union_loose(*dfs: DataFrame) -> DataFrame:
    """Union of tables with different columns; absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def intersect_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys that both have; made distinct first, so that a hot key is one row."""
    return a.select(*on).distinct().intersect(b.select(*on).distinct())


def except_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of ``a`` without those of ``b``, occurrence by occurrence."""
    return a.select(*on).exceptAll(b.select(*on))


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, dfs).distinct()
