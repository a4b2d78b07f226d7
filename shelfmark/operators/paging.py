"""Pages of a sorted result by an index of its key ranges."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from shelfmark.session import hand_over
from shelfmark.skew import place_rows

RANGE_ROWS = 10_000
MOST_RANGES = 20_000
TASK_ROWS = 200_000  # keys that one task sorts


class PageIndex:
    """Borders of ranges of a sorted table with the number of rows before each.

    ``order`` names columns, with a ``-`` in front for falling order; nulls come first in rising and
    last in falling order. The index is made once, by sorting the key columns alone, and kept in the
    shared folder; it has a row per range, about one for ``rows`` rows and about
    ``MOST_RANGES`` at most. A task sorts many ranges, so their number costs no tasks. Equal keys are always in one range. A page then reads only rows of the ranges it
    lies in: their borders are filters on the key columns, of which the first is pushed down to the
    files. The table must not change meanwhile. End ``order`` with a unique key for repeatable pages.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], rows: int = RANGE_ROWS):
        self.df = df
        self.keys = [(o.removeprefix("-"), o.startswith("-")) for o in order]
        keys = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, (c, _) in enumerate(self.keys)])
        total = keys.count()
        step = max(1, rows, math.ceil(total / MOST_RANGES))
        by = [F.desc(f"k{i}") if falling else F.asc(f"k{i}") for i, (_, falling) in enumerate(self.keys)]
        placed = place_rows(keys, by, max(1, math.ceil(total / TASK_ROWS)))
        names = [f"k{i}" for i in range(len(self.keys))]
        # the key of each ``step``-th row is a border; its range begins with the first row of that key
        cuts = placed.where(F.col("_place") % step == 0).select(*[F.col(c).alias(f"_{c}") for c in names]).distinct()
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])
        starts = placed.join(F.broadcast(cuts), same, "left_semi").groupBy("_range", *names).agg(F.min("_place").alias("_place"))
        sizes = placed.groupBy("_range").agg(F.count("*").alias("size"))
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("_range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
        ranges = starts.join(F.broadcast(offsets), "_range").select(
            (F.col("offset") + F.col("_place")).alias("before"), F.struct(*names).alias("border")
        )
        following = F.lead("before", 1, total).over(Window.orderBy("before"))
        self.ranges = hand_over(ranges.select("before", (following - F.col("before")).alias("rows"), "border"), "page-index")

    def _order(self) -> list[Column]:
        return [F.desc(f"`{c}`") if falling else F.asc(f"`{c}`") for c, falling in self.keys]

    def _from(self, border: Row) -> Column:
        """Whether a row is at or after ``border``."""
        reached = F.lit(True)
        for (name, falling), value in reversed(list(zip(self.keys, border, strict=True))):
            col, given = F.col(f"`{name}`"), F.lit(value).cast(self.df.schema[name].dataType)
            if value is None:
                after = F.lit(False) if falling else col.isNotNull()
            else:
                beyond = col < given if falling else col > given
                after = (col.isNull() | beyond) if falling else beyond
            reached = F.coalesce(after, F.lit(False)) | (col.eqNullSafe(given) & reached)
        return reached

    def rows_of(self, limit: int, offset: int = 0) -> tuple[DataFrame, int]:
        """The rows of the ranges in which a page lies, and how many rows of the table come before
        them. Two rows of the index come to the driver.
        """
        first = self.ranges.where(F.col("before") <= offset).agg(F.max_by(F.struct("border", "before"), "before").alias("r")).first()["r"]
        end = self.ranges.where(F.col("before") >= offset + limit).agg(F.min_by("border", "before").alias("b")).first()["b"]
        rows, before = self.df, 0
        if first is not None and first["before"] > 0:
            before = first["before"]
            rows = rows.where(self._pushed_from(first["border"])).where(self._from(first["border"]))
        if end is not None:
            rows = rows.where(self._pushed_to(end)).where(~self._from(end))
        return rows, before

    def _pushed_from(self, border: Row) -> Column:
        """A condition on the first key alone that every row at or after ``border`` meets."""
        (name, falling), value = self.keys[0], border[0]
        col = F.col(f"`{name}`")
        if value is None:
            return col.isNull() if falling else F.lit(True)
        given = F.lit(value).cast(self.df.schema[name].dataType)
        return (col.isNull() | (col <= given)) if falling else col >= given

    def _pushed_to(self, border: Row) -> Column:
        """A condition on the first key alone that every row before ``border`` meets."""
        (name, falling), value = self.keys[0], border[0]
        col = F.col(f"`{name}`")
        if value is None:
            return F.lit(True) if falling else col.isNull()
        given = F.lit(value).cast(self.df.schema[name].dataType)
        return col >= given if falling else (col.isNull() | (col <= given))

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """``limit`` rows from row number ``offset`` on, in order."""
        rows, before = self.rows_of(limit, offset)
        return rows.orderBy(*self._order()).offset(offset - before).limit(limit)
