"""Writers, JSON lines, batches and the calendar of log partitions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.skew import number_rows


def write_partitioned(
    df: DataFrame,
    cols: Sequence[str],
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
    codec: str = "snappy",
    mode: str = "overwrite",
    rows_per_file: int = 5_000_000,
) -> None:
    """Write folders by ``cols``, to a path or a registered table.

    The rebalance before the write gathers the rows of a folder, and lets adaptive execution
    split a folder that holds far more than the others.
    """
    writer = (
        df.hint("rebalance", *cols)
        .write.format(fmt)
        .option("compression", codec)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*cols)
        .mode(mode)
    )
    if table is None:
        if path is None:
            raise ValueError("a path or a table name is needed")
        writer.save(path)
    else:
        (writer.option("path", path) if path else writer).saveAsTable(table)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV that ``scan_csv`` reads back: quotes doubled, blanks kept."""
    (
        df.write.option("header", header)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode(mode)
        .csv(path)
    )


def to_ndjson(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One JSON line per row; null attributes are left out."""
    return df.select(F.to_json(F.struct(*(cols or df.columns))).alias("value"))


def chunk_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """Number rows over the whole table and cut them in batches of ``n``."""
    position = F.col("_rn") - 1
    return (
        number_rows(df, order_by, "_rn")
        .withColumn("chunk", F.floor(position / n))
        .withColumn("pos", position % n + 1)
        .drop("_rn")
    )


def chunk_bodies(chunks: DataFrame, line: str, sep: str = "\n") -> DataFrame:
    """Request body per batch: the lines of a batch in order."""
    items = F.sort_array(F.collect_list(F.struct("pos", line)))
    return chunks.groupBy("chunk").agg(
        F.count("*").alias("n"),
        F.array_join(F.transform(items, lambda i: i[line]), sep).alias("body"),
    )


def partition_spine(
    spark: SparkSession, start: dt.date, end: dt.date, regions: Sequence[str], root: str
) -> DataFrame:
    """Every (region, year, month, day) from ``start`` to ``end`` with its folder."""
    one = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
        ).alias("date")
    )
    days = one.select("date", F.explode(F.array(*map(F.lit, regions))).alias("region"))
    parts = days.select(
        "region",
        F.date_format("date", "yyyy").alias("year"),
        F.date_format("date", "MM").alias("month"),
        F.date_format("date", "dd").alias("day"),
        "date",
    )
    return parts.withColumn(
        "location",
        F.concat(F.concat_ws("/", F.lit(root), "region", "year", "month", "day"), F.lit("/")),
    )


def missing_partitions(spine: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Partitions of the spine that hold no data."""
    return spine.join(present.select(*on).distinct(), list(on), "left_anti")
