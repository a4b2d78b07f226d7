"""Words, rows and keys as the operators of this package see them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# words are what lies between these characters
BLANKS = r"[\x20\x09-\x0D]"
BLANK_CHARS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
ROW = "_row"
MOST_LABELS = 10_000


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z; every other character stays, so no text changes its length."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), "")


def sums_before(lengths: Column, block: int = 256) -> Column:
    """For each number of an array the sum of those before it.

    Sums are taken in blocks and then over the blocks, as every step copies the sums so far: so the work
    grows with the array as long as that has no more than some million numbers.
    """

    def add(state: Column, x: Column) -> Column:
        total = state["total"] + x
        return F.struct(total.alias("total"), F.concat(state["sums"], F.array(state["total"])).alias("sums"))

    def add_block(state: Column, b: Column) -> Column:
        own = F.struct(state["total"].alias("before"), b["sums"].alias("sums"))
        return F.struct(
            (state["total"] + b["total"]).alias("total"), F.concat(state["blocks"], F.array(own)).alias("blocks")
        )

    none = F.array().cast("array<bigint>")
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), none.alias("sums"))
    last = F.floor((F.size(lengths) - 1) / block).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(lengths, b * block + 1, block))
    summed = F.transform(blocks, lambda part: F.aggregate(part, zero, add))
    no_blocks = F.array().cast("array<struct<before:bigint,sums:array<bigint>>>")
    no_block = F.struct(F.lit(0).cast("bigint").alias("total"), no_blocks.alias("blocks"))
    placed = F.aggregate(summed, no_block, add_block)["blocks"]
    found = F.flatten(F.transform(placed, lambda b: F.transform(b["sums"], lambda x: b["before"] + x)))
    return F.when(F.size(lengths) > 0, found).otherwise(none)


def nest(df: DataFrame, carry: Sequence[str] | None = None, **columns: Column) -> DataFrame:
    """Whole rows, or the columns to carry, as one struct beside an operator's columns, so that
    no names can clash.
    """
    kept = df.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias(ROW)
    return df.select(row, *[c.alias(name) for name, c in columns.items()])


def unnest(df: DataFrame, outputs: Sequence[str]) -> DataFrame:
    """Rows as they were, and ``outputs``, which take the place of columns of that name."""
    taken = {o.lower() for o in outputs}
    fields = [f for f in df.schema[ROW].dataType.names if f.lower() not in taken]
    return df.select(*[F.col(ROW)[f].alias(f) for f in fields], *outputs)


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether a document is kept from learning; one without an id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), folds) == fold, F.lit(False))


def hash_share(df: DataFrame, key: str, share: Column) -> DataFrame:
    """The given share of the rows, chosen by a hash of ``key``."""
    space = 1 << 30
    place = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(space))
    return df.where(place < share * space)


def labelled_sample(df: DataFrame, by: str, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows of each value of ``by`` at most, chosen by a hash of ``key``.

    The counts per value are taken over all rows; a value with no more than ``bound`` rows
    keeps them all. Nothing is sorted and no group is brought together: the shares come to the
    driver if there are at most ``MOST_LABELS`` of them, and rows are chosen where they are read.
    With more values than that the shares are joined.
    """
    counts = df.groupBy(by).agg((F.lit(float(bound)) / F.count("*")).alias("_share"))
    found = counts.limit(MOST_LABELS + 1).collect()
    if len(found) <= MOST_LABELS:
        counts = F.broadcast(df.sparkSession.createDataFrame(found, counts.schema))
    return hash_share(df.join(counts, by), key, F.col("_share")).drop("_share")
