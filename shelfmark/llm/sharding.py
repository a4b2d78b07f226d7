"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import nest, unnest
from shelfmark.skew import number_rows

ROUNDS = 6


def feistel(df: DataFrame, name: str, rows: int, seed: int, rounds: int = ROUNDS) -> DataFrame:
    """One pass of the permutation over 0 .. a * b - 1, with a = ceil(sqrt(rows)) and the least b
    for which a * b >= rows, applied to the column ``name``.

    A number is split into its quotient and remainder by b. Rounds add a hash of one half to the
    other, modulo that half's range; each round can be undone, so the whole is a permutation.
    """
    a = math.isqrt(rows - 1) + 1
    b = -(-rows // a)

    def mixed(half: str, k: int, size: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(int(seed)).cast("bigint"), F.lit(k), F.col(half)), F.lit(size))

    df = df.withColumns({"_l": F.expr(f"{name} div {b}"), "_r": F.pmod(F.col(name), F.lit(b))})
    for k in range(rounds):
        half, other, size = ("_l", "_r", a) if k % 2 == 0 else ("_r", "_l", b)
        df = df.withColumn(half, F.pmod(F.col(half) + mixed(other, k, size), F.lit(size)))
    return df.withColumn(name, F.col("_l") * F.lit(b) + F.col("_r")).drop("_l", "_r")


def _walked(df: DataFrame, name: str, rows: int, seed: int, steps: int) -> DataFrame:
    """Cycle walking: the permutation again wherever it led beyond the last row."""
    df = feistel(df, name, rows, seed)
    for _ in range(steps):
        df = feistel(df.withColumn("_next", F.col(name)), "_next", rows, seed)
        df = df.withColumn(name, F.when(F.col(name) >= rows, F.col("_next")).otherwise(F.col(name)))
        df = df.drop("_next")
    return df


def walk_steps(spark: SparkSession, rows: int, seed: int) -> int:
    """How many further passes bring every row back: the longest way through the numbers beyond
    the last row. There are fewer of those than the square root of ``rows``, so all are tried.
    """
    a = math.isqrt(rows - 1) + 1
    end = a * -(-rows // a)
    out = spark.range(rows, end).withColumnRenamed("id", "p")
    steps = 0
    while end > rows:
        steps += 1
        out = feistel(out, "p", rows, seed).where(F.col("p") >= rows)
        if out.isEmpty():
            break
    return steps


def shard(
    df: DataFrame,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Rows of ``df`` (or its columns ``carry``) with ``shard`` and ``slot``: row counts of shards are at most one apart, slots run from 0.

    Rows are numbered in the order of id, then text checksum and size, over range partitions; a
    keyed permutation sends number i to p(i), and p mod ``shards`` is the shard, p div ``shards``
    the slot. The place of a row can thus be computed from its number alone, and the same table
    gives the same places however it is partitioned. Also adds ``size`` (UTF-8 bytes of the text
    and 16) and ``text_crc32``.

    Null ids come first, a null text has no bytes; repeated rows are numbered one after the other
    and spread like others. An empty table gives an empty result. Columns named like the added
    ones are replaced.
    """
    body = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    rows = nest(
        df,
        carry,
        doc_id=F.col(f"`{doc_id}`"),
        size=F.octet_length(body).cast("bigint") + 16,
        text_crc32=F.crc32(body),
    )
    added = ["size", "text_crc32", "shard", "slot"]
    numbered = number_rows(rows, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "rn")
    count = numbered.count()
    placed = numbered.withColumn("p", F.col("rn") - 1)
    if count > 1:
        placed = _walked(placed, "p", count, seed, walk_steps(df.sparkSession, count, seed))
    placed = placed.withColumns(
        {"shard": F.pmod("p", F.lit(shards)).cast("int"), "slot": F.expr(f"p div {int(shards)}")}
    )
    return unnest(placed, added)
