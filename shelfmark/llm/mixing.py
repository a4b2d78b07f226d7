"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import nest, unnest, words
from shelfmark.skew import number_rows

_BEFORE = (Window.unboundedPreceding, -1)


def text_size(text: Column) -> Column:
    """Number of words."""
    return F.size(words(text)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """Target size of every source: ``share`` of all sizes, split by weight.

    Sources by code point, null last, take the weights in turn. No target exceeds ``most`` times
    the source's size; what is cut off goes to the others by weight, until none is above. The
    cut sources are those with the least room per weight, so one pass in that order finds them:
    a source is cut when its share of what earlier cuts have left is above its own room.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    everything = Window.partitionBy(F.lit(0))
    rising = Window.orderBy(F.col("source_size") / F.col("w"), "place")
    before = rising.rowsBetween(*_BEFORE)
    found = (
        totals.withColumn("place", place)
        .withColumn("w", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("room", F.col("source_size") * F.lit(float(most)))
        .withColumn("all_target", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("cut", F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .withColumn("cut_w", F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("left", F.col("all_target") - F.col("cut"))
        .withColumn("left_w", F.col("all_w") - F.col("cut_w"))
        .withColumn("is_cut", F.col("left") * F.col("w") > F.col("room") * F.col("left_w"))
    )
    # what the first uncut source sees as left is split among all that are not cut
    rest = F.first(F.when(~F.col("is_cut"), F.struct("left", "left_w")), ignorenulls=True).over(
        rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("is_cut"), F.col("room")).otherwise(
        F.col("rest.left") * F.col("w") / F.col("rest.left_w")
    )
    return found.withColumn("rest", rest).select(
        "source", "source_size", "source_rows", "place", target.alias("target")
    )


def mix(
    df: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    text: str = "text",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 0,
) -> DataFrame:
    """Rows of ``df`` with the ``copies`` of each that the mix takes, 0 included.

    Also adds ``size`` (words of the text unless given; null: 0), ``source_size`` and ``target``.
    A document of a source is expected ``target / source_size`` times. Within a source the
    documents are put in the order of size, then of a hash; the expected copies are summed up in
    that order, a random offset per source is added, and a document is taken once for every
    integer boundary its step crosses. As sizes rise along the order, the words taken differ
    from the target by no more than the largest size.

    Ranks come from range partitions over (source, size, hash), so neither a hot source nor
    many documents of one size meet in a task. Only the table of sources runs in one task.

    Null ids, texts and sources are values like others; repeated rows are separate rows, and a
    document of size 0 gets copies like any other. A source of total size 0 takes nothing. An
    empty table gives an empty result. Columns named like the added ones are replaced.
    """
    size = text_size(F.col(f"`{text}`")) if size is None else size
    rows = nest(
        df,
        doc_id=F.col(f"`{doc_id}`"),
        source=F.col(f"`{source}`"),
        size=F.coalesce(size, F.lit(0)).cast("bigint"),
    )
    targets = source_targets(rows, weights, share, most)
    salted = F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))
    order = [
        F.col("source").asc_nulls_last(),
        F.col("size"),
        F.substring(F.md5(salted.cast("binary")), 1, 8),
        F.col("doc_id"),
    ]
    numbered = number_rows(rows, order, "rn")
    earlier = Window.orderBy("place").rowsBetween(*_BEFORE)
    targets = targets.withColumn(
        "rows_before", F.coalesce(F.sum("source_rows").over(earlier), F.lit(0))
    ).withColumnRenamed("source", "t_source")
    draw = F.md5(F.concat(F.lit(f"{seed}:offset:"), F.col("place").cast("string")).cast("binary"))
    offset = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = F.col("rn") - F.col("rows_before")
    copies = F.floor(F.col("u") + F.col("rate") * rank) - F.floor(
        F.col("u") + F.col("rate") * (rank - 1)
    )
    drawn = (
        numbered.join(targets, F.col("source").eqNullSafe(F.col("t_source")), "left")
        .withColumn("u", offset)
        .withColumn("rate", rate)
        .withColumn("copies", copies.cast("bigint"))
    )
    return unnest(drawn, ["size", "source_size", "target", "copies"])


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row as often as ``copies`` says, with ``columns`` only."""
    once = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return (
        mixed.where("copies > 0")
        .select(*[F.col(f"`{c}`") for c in columns], once.alias("_copy"))
        .drop("_copy")
    )
