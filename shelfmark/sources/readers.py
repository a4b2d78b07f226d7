"""Readers for the file formats metadata arrives in. Schemas are given, never inferred."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import hand_over
from shelfmark.skew import lookup_join


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header; quotes are doubled inside a field.

    Files are split over tasks, with ``multiline`` too (see ``csv_records``), which lets fields hold
    line breaks.
    """
    if multiline:
        return _parsed_records(spark, path, schema, sep)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .csv(path)
    )


def scan_pieces(spark: SparkSession, path: str, end: str, name: str = "content") -> DataFrame:
    """What stands between the marks ``end`` in text files, cut by any number of tasks.

    Rows have ``file``, ``block`` (where the split begins that holds the piece) and ``place``, which is
    in the order of the text within a block. A piece that crosses the border of two splits belongs
    to the first.
    """
    return (
        spark.read.option("lineSep", end)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.col("value").alias(name),
        )
    )


def csv_records(lines: DataFrame) -> DataFrame:
    """(file, record, is_first) of the lines (file, block, place, value) of CSV files: a record goes
    on over line breaks that stand between quotes. In a file whose first line ends with CR and LF, such
    pairs are line breaks inside of records too and become LF, as Spark's reader has it.

    A line begins a record if the quotes before it in its file are even in number. So the parity of
    whole blocks is summed up first, one row per block, and then that of the lines within each block;
    no task needs more than a block. Records that cross blocks are put together after that, and
    only those are shuffled again. Quotes stand around a field or are doubled in it.
    """
    by_block = Window.partitionBy("file").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("file", "block").orderBy("place")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.withColumn("quotes", quotes % 2)
    parity = counted.groupBy("file", "block").agg(
        F.sum("quotes").alias("odd"), F.min_by(F.endswith("value", F.lit("\r")), "place").alias("pairs")
    )
    parity = parity.select(
        "file",
        "block",
        F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("before"),
        (F.sum("odd").over(by_block) % 2 == 1).alias("goes_on"),
        (F.row_number().over(by_block) == 1).alias("first_block"),
        F.first("pairs").over(by_block).alias("pairs"),
    )
    before = F.col("before") + F.coalesce(
        F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    begins = (before % 2 == 0).cast("int")
    # 0: the lines of a block that belong to a record of an earlier one
    numbered = (
        lookup_join(counted, parity, ["file", "block"])
        .withColumn("begins", begins)
        .withColumn("no", F.sum("begins").over(in_block))
    )
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "\n")
    parts = hand_over(
        numbered.groupBy("file", "block", "no").agg(
            text.alias("record"), *[F.first(c).alias(c) for c in ("goes_on", "first_block", "pairs")]
        ),
        "csv-records",
    )
    is_first = F.col("first_block") & (F.col("no") == 1)
    last = parts.groupBy("file", "block").agg(F.max("no").alias("last_no"))
    # of a block whose lines all go on a record, the block where that began
    began = last.select(
        "file",
        "block",
        "last_no",
        F.last(F.when(F.col("last_no") > 0, F.struct("block", "last_no")), ignorenulls=True).over(earlier).alias("began"),
    )
    placed = lookup_join(parts, began, ["file", "block"])
    crosses = (F.col("no") == 0) | (F.col("goes_on") & (F.col("no") == F.col("last_no")))
    whole = placed.where(~crosses).select("file", "record", is_first.alias("is_first"), "pairs")
    own = F.struct("block", F.col("no").alias("last_no"))
    crossing = (
        placed.where(crosses)
        .withColumn("key", F.when(F.col("no") == 0, F.col("began")).otherwise(own))
        .groupBy("file", "key")
        .agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "no", "record"))), lambda x: x["record"]), "\n").alias("record"),
            F.bool_or(is_first).alias("is_first"),
            F.first("pairs").alias("pairs"),
        )
    )
    every = whole.unionByName(crossing.select("file", "record", "is_first", "pairs"))
    broken = F.when(F.col("pairs"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    return every.select("file", F.regexp_replace(broken, "\r$", "").alias("record"), "is_first")


def _parsed_records(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str
) -> DataFrame:
    fields = schema.toDDL() if isinstance(schema, T.StructType) else schema
    lines = hand_over(scan_pieces(spark, path, "\n", "value"), "csv-lines")
    body = csv_records(lines).where("not is_first")
    options = {"sep": sep, "escape": '"', "multiLine": "true"}
    return body.where("record <> ''").select(F.from_csv("record", fields, options).alias("row")).select("row.*")


def scan_ndjson_nested(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_partitioned_log(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str,
    region: str,
    start: dt.date,
    end: dt.date,
    fmt: str = "json",
) -> DataFrame:
    """Days ``start`` to ``end`` of a tree region=/year=/month=/day=.

    Only partition columns are compared, so other folders are never opened.
    """
    df = spark.read.schema(schema).format(fmt).load(root)
    number = (
        F.col("year").cast("int") * 10000
        + F.col("month").cast("int") * 100
        + F.col("day").cast("int")
    )
    first = start.year * 10000 + start.month * 100 + start.day
    last = end.year * 10000 + end.month * 100 + end.day
    return df.where((F.col("region") == region) & number.between(first, last))


def scan_json_document(
    spark: SparkSession, path: str, schema: T.StructType | str, rows_path: str
) -> DataFrame:
    """Files holding one JSON document each; one row per element of the array at ``rows_path``."""
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    return docs.select(F.explode(rows_path).alias("row")).select("row.*")


def scan_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """Result of a SQL text, read in parallel slices of a numeric column if one is given."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("a partition column needs its lower and upper bound")
    return (
        reader.option("dbtable", f"({query}) source")
        .option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
    )


def page_union(pages: DataFrame, keys: Sequence[str], page_col: str) -> DataFrame:
    """Rows of landed result pages, once per key; the latest page wins.

    Only one row per key and input partition is shuffled.
    """
    latest = Window.partitionBy(*keys).orderBy(F.desc(page_col))
    return (
        pages.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").drop("_rn")
    )


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty files below ``path`` with size, first and second level folder.

    File contents are not read.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", F.col("length").alias("size"))
    )
    inside = F.split(F.substring_index("path", path.rstrip("/") + "/", -1), "/")
    return files.where("size > 0").select(
        "path",
        F.when(F.size(inside) > 1, inside[0]).alias("top"),
        F.when(F.size(inside) > 2, inside[1]).alias("second"),
        "size",
    )
