"""Epoch, partition and ISO text functions; sessions run in UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def to_unix(ts: str | Column) -> Column:
    """Whole seconds since the epoch."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def date_parts(epoch: str | Column) -> dict[str, Column]:
    """Timestamp, year, month and day of epoch seconds."""
    ts = F.timestamp_seconds(_col(epoch))
    return {"full_date": ts, "year": F.year(ts), "month": F.month(ts), "day": F.day(ts)}


def relative_date_filter(
    year: str, month: str, day: str, as_of: dt.date, days: int = 1
) -> Column:
    """Partition filter for the day ``days`` before ``as_of``; the columns hold padded text.

    The parts are literals, so the filter prunes partitions.
    """
    wanted = as_of - dt.timedelta(days=days)
    return (
        (F.col(year) == f"{wanted.year:04d}")
        & (F.col(month) == f"{wanted.month:02d}")
        & (F.col(day) == f"{wanted.day:02d}")
    )


def iso_format(ts: str | Column) -> Column:
    """ISO-8601 text in UTC, to the second."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
