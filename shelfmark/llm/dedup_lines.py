"""Dropping lines that many documents share, by levelled sorted runs of line hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import BLANK_CHARS, lower_ascii, nest, unnest
from shelfmark.session import drop_scratch, hand_over, scratch_log

KEY = ["h1", "h2"]
LARGEST = (1 << 63) - 1
RUN = "h1 bigint, h2 bigint, n_docs bigint, keeper bigint"


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANK_CHARS)))


def hashes(key: Column) -> list[Column]:
    """128 bits, so that different lines do not meet even among 10 ** 12."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("2"), key).alias("h2")]


class LineRuns:
    """Sorted runs of (line hash, number of documents, largest document id), in levels.

    A new run goes to level 0. When a level has ``fanout`` runs they are merged into one of the
    next level, so a hash is rewritten once per level and there are never more than
    ``fanout`` runs a level. Runs are files in the shared folder, written once and deleted when
    merged; only their list is held here. The batches added must have different documents.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[tuple[DataFrame, list[str]]]] = []

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        placed = run.repartition(*KEY).sortWithinPartitions(*KEY)
        with scratch_log() as paths:
            written = hand_over(placed, f"line-run-{level}")
        self.levels[level].append((written, paths))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._put(self._merged([run for run, _ in merged]), level + 1)
            drop_scratch(self.spark, [path for _, paths in merged for path in paths])

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run, _ in level]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return (
            reduce(DataFrame.unionByName, runs)
            .groupBy(*KEY)
            .agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        )

    def add(self, lines: DataFrame) -> None:
        """A run of the lines (h1, h2, doc_id) of a batch of documents. Lines without a hash
        are left out; a line counts once per document, documents without id as one.
        """
        once = lines.where("h1 is not null").select(*KEY, "doc_id").distinct()
        run = once.groupBy(*KEY).agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")
        )
        self._put(run, 0)

    def keys(self) -> DataFrame:
        """All hashes with their totals over the runs."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], RUN)
        return runs[0] if len(runs) == 1 else self._merged(runs)

    def held(self, min_docs: int = 1) -> DataFrame | None:
        """The hashes that some run alone holds for ``min_docs`` documents, None without runs. The
        filter is pushed to the runs' files, nothing is merged; totals can only be larger.
        """
        runs = [run.where(F.col("n_docs") >= min_docs).select(*KEY) for run in self._runs()]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def anti_join(self, lines: DataFrame, min_docs: int = 1) -> DataFrame:
        """The ``lines`` of a new batch whose hash no run holds for ``min_docs`` documents."""
        held = self.held(min_docs)
        return lines if held is None else lines.join(held.hint("merge"), KEY, "left_anti")

    def anti_join_totals(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """The ``lines`` whose hash all runs together hold for fewer than ``min_docs`` documents, and
        those of the document with the largest id of those that hold it.
        """
        held = self.keys().where(F.col("n_docs") >= min_docs).select(
            F.col("h1").alias("r1"), F.col("h2").alias("r2"), "keeper"
        )
        same = (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2"))
        same = same & ~F.col("doc_id").eqNullSafe(F.col("keeper"))
        return lines.join(held.hint("merge"), same, "left_anti")


def id_ranges(rows: DataFrame, batches: int) -> list[Column]:
    """Conditions for ``batches`` ranges of doc_id with about equal numbers of rows, from the largest
    ids down; rows without id are in the last. An id is in one range only.
    """
    shares = [k / batches for k in range(batches - 1, 0, -1)]
    found = rows.approxQuantile("doc_id", shares, 0.1 / batches) if shares else []
    borders = sorted({min(int(x), LARGEST) for x in found}, reverse=True)
    tops = [None, *borders]
    ranges = []
    for top, low in zip(tops, [*borders, None], strict=True):
        below = F.lit(True) if top is None else F.col("doc_id") <= top
        if low is None:
            ranges.append(F.col("doc_id").isNull() | below)
        else:
            ranges.append(below & (F.col("doc_id") > low))
    return ranges


def text_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row per line of (doc_id, t1, t2, text): its position and hash; short lines have none."""
    cut = rows.select(
        "doc_id", "t1", "t2", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    ).withColumn("key", line_key(F.col("line")))
    long = F.length("key") >= min_chars
    return cut.select(
        "doc_id", "t1", "t2", "pos",
        *[F.when(long, h).alias(name) for name, h in zip(KEY, hashes(F.col("key")), strict=True)],
    )


def drop_common_lines(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 4,
    batch_docs: int = 1 << 31,
) -> DataFrame:
    """Rows of ``df`` with ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    A text is split at newlines. A line's key is the line without blanks at its ends, A-Z
    lower-cased; keys of at least ``min_chars`` code points that at least ``min_docs`` documents
    hold lose all their lines but those in the document with the largest id. The others stay as
    they are, joined by newlines.

    The documents come in batches from the largest id down, ``batches`` of them or as many as
    hold ``batch_docs`` each. A batch is merge-anti-joined with the runs of ``LineRuns``: its lines
    that a run holds for ``min_docs`` documents, all of larger ids, are lost at once and counted no
    more. The batch adds a run of what is left. Only these open lines wait for the totals, with
    which they are anti-joined after the last batch; what then is left is put together by document.
    Line texts are never shuffled, only hashes and positions; whole texts are, once, to meet their
    kept positions. Short lines have no hash and take part in no join.

    A null or empty text is one empty line. Rows with one id are one document for the counts,
    those without id are one too, and come before all others; repeated rows lose the same lines.
    An empty table gives an empty result. Columns named like the added ones are replaced.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = nest(
        df,
        doc_id=F.col(f"`{doc_id}`").cast("bigint"),
        text=body,
        t1=F.xxhash64(body),
        t2=F.xxhash64(F.lit("2"), body),
    )
    spark = df.sparkSession
    with scratch_log() as paths:
        lines = hand_over(text_lines(rows, min_chars), "lines")
    ids = rows.select("doc_id")
    runs, left = LineRuns(spark, fanout), []
    for of_batch in id_ranges(ids, max(batches, -(-ids.count() // batch_docs))):
        batch = lines.where(of_batch)
        # short lines would all meet under one key
        long = runs.anti_join(batch.where("h1 is not null"), min_docs)
        left.append(hand_over(long.unionByName(batch.where("h1 is null")), "open-lines"))
        runs.add(left[-1])
    drop_scratch(spark, paths)
    waiting = reduce(DataFrame.unionByName, left)
    kept = (
        runs.anti_join_totals(waiting.where("h1 is not null"), min_docs)
        .unionByName(waiting.where("h1 is null"))
        .groupBy(F.col("doc_id").alias("k_id"), F.col("t1").alias("k1"), F.col("t2").alias("k2"))
        .agg(F.array_sort(F.collect_set("pos")).alias("at"))
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("k_id"))
        & (F.col("t1") == F.col("k1"))
        & (F.col("t2") == F.col("k2"))
    )
    found = rows.join(kept, same, "left").withColumn("_lines", F.split("text", "\n"))
    found_lines = F.transform("at", lambda p: F.get(F.col("_lines"), p))
    whole = found.select(
        "_row",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.coalesce(F.size("at"), F.lit(0))).cast("bigint").alias("n_dropped"),
        F.coalesce(F.array_join(found_lines, "\n"), F.lit("")).alias("kept_text"),
    )
    return unnest(whole, ["kept_text", "n_lines", "n_dropped"])
