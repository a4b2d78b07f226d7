"""Ranked word search over an inverted index that is written once."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import text
from shelfmark.session import scratch_path

BUCKETS = 64
BLOCK = 2_000_000
SLICE = 1 << 23
# what text.tokens keeps of the UTF-8 bytes of a text
_IN_WORD = np.zeros(256, bool)
_IN_WORD[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")] = True


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists (term, times, block, ids) of the words of the texts in batches of (id, block, text).

    Texts are read in slices of about ``SLICE`` bytes, each of which has lists of its own.
    """
    for batch in batches:
        texts = batch["text"].cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, "right")) - 1)
            if ends[upto] > ends[at]:
                chars = np.frombuffer(texts.buffers()[2], np.uint8)[ends[at] : ends[upto]]
                yield _slice_lists(batch.slice(at, upto - at), chars, ends[at : upto + 1] - ends[at])
            at = upto


def _slice_lists(rows: pa.RecordBatch, chars: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """Lists of some texts, given as their bytes and the places where they begin and end."""
    in_word = _IN_WORD[chars]
    begins = in_word.copy()
    begins[1:] &= ~in_word[:-1]
    # no word goes on from one text to the next
    heads = bounds[:-1][bounds[:-1] < len(chars)]
    begins[heads] = in_word[heads]
    row = np.repeat(np.arange(rows.num_rows), np.diff(np.searchsorted(np.flatnonzero(begins), bounds)))
    letters = chars[in_word]
    cuts = np.append(np.flatnonzero(begins[in_word]), len(letters))
    words = pa.LargeStringArray.from_buffers(len(row), pa.py_buffer(cuts), pa.py_buffer(letters)).dictionary_encode()
    # rows are numbered in the order of their blocks, so that a list is a stretch of equal term, times and block
    order = np.argsort(rows["block"].to_numpy(), kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    found = np.sort(words.indices.to_numpy().astype(np.int64) * len(order) + place[row])
    first = np.flatnonzero(np.diff(found, prepend=-1))
    times = np.diff(first, append=len(found))
    most = int(times.max(initial=0)) + 1
    term, place = np.divmod(found[first], len(order))
    group, place = np.divmod(np.sort((term * most + times) * len(order) + place), len(order))
    row = order[place]
    block = rows["block"].to_numpy()[row]
    lists = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    cuts = pa.array(np.append(lists, len(row)).astype(np.int32))
    term, times = np.divmod(group[lists], most)
    return pa.RecordBatch.from_arrays(
        [
            words.dictionary.cast(pa.string()).take(pa.array(term)),
            pa.array(times.astype(np.int32)),
            pa.array(block[lists]),
            pa.ListArray.from_arrays(cuts, rows["id"].take(pa.array(row))),
        ],
        names=["term", "times", "block", "ids"],
    )


class TermIndex:
    """Words of texts with the rows that have them, in a folder of Parquet files.

    A posting is a term, the id of a row that has it, and how often. Those of a term and number of times
    are written as lists, each of rows that were read together: a word that every text has is many lists, and
    no list grows with the table. Lists are dealt by a hash of the term to ``BUCKETS`` folders, there by
    a hash of the id to a file for about ``BLOCK`` ids each, and sorted by term: a search opens only the
    folders of its terms, and reads of their files only the row groups that may hold them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        size = spark.read.parquet(f"{path}/size").first()
        self.rows = size["rows"]
        lists = spark.read.parquet(f"{path}/postings")
        self.postings = lists.select("term", F.explode("ids").alias("id"), "times", "bucket")
        if size["texts"] > size["rows"]:
            times = F.sum("times").cast("int").alias("times")
            self.postings = self.postings.groupBy("term", "id", "bucket").agg(times)

    @classmethod
    def build(cls, df: DataFrame, row_id: str, column: str, path: str | None = None) -> TermIndex:
        """Index the whole texts of ``column``. Rows of one id count as one text; null and blank
        texts have no words but count as rows.

        The words of a row are counted where it is read, and lists of postings are shuffled once. Only if ids
        repeat, the counts of their rows are added up when terms are asked for.
        """
        spark = df.sparkSession
        path = path or scratch_path(spark, "term-index")
        ids = F.count_distinct(F.coalesce(F.col(row_id).cast("string"), F.lit("")))
        df.agg(ids.alias("rows"), F.count("*").alias("texts")).write.parquet(f"{path}/size")
        size = spark.read.parquet(f"{path}/size").first()
        blocks = max(1, math.ceil(size["rows"] / BLOCK))
        # the block of a posting depends on its id alone, so a task that is run again deals all out as before
        texts = (
            df.where(F.col(column).isNotNull())
            .select(F.col(row_id).alias("id"), F.lower(column).alias("text"))
            .select("id", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "text")
        )
        ids = T.ArrayType(texts.schema["id"].dataType)
        lists = T.StructType().add("term", T.StringType()).add("times", T.IntegerType())
        (
            texts.mapInArrow(_lists, lists.add("block", T.IntegerType()).add("ids", ids))
            .withColumn("bucket", cls._bucket(F.col("term")))
            .repartition("bucket", "block")
            .drop("block")
            .sortWithinPartitions("bucket", "term")
            .write.partitionBy("bucket")
            .parquet(f"{path}/postings")
        )
        return cls(spark, path)

    @staticmethod
    def _bucket(term: Column) -> Column:
        return F.pmod(F.crc32(term.cast("binary")), F.lit(BUCKETS)).cast("int")

    def _asked(self, terms: Sequence[str]) -> DataFrame:
        """Postings of the terms asked for."""
        buckets = sorted({crc32(t.encode()) % BUCKETS for t in terms})
        return self.postings.where(F.col("bucket").isin(buckets) & F.col("term").isin(list(terms)))

    def search(self, query: str, mode: str = "any", k: int | None = None) -> DataFrame:
        """(id, n_terms, score) of the rows that have any or all words of ``query``, with the best
        score first if ``k`` asks for only so many; ties by id.

        A word counts as often as the row has it, times ln(1 + rows / rows that have it). A query
        without words finds nothing.
        """
        if mode not in ("any", "all"):
            raise ValueError(f"unknown search mode {mode!r}")
        asked = self.spark.range(1).select(F.explode(F.array_distinct(text.tokens(F.lit(query)))).alias("t"))
        terms = sorted(r["t"] for r in asked.collect())
        postings = self._asked(terms)
        # one row per term that is asked for
        frequency = postings.groupBy("term").agg(F.count("*").alias("n_rows"))
        hits = postings.join(F.broadcast(frequency), "term")
        weight = F.log1p(F.lit(float(self.rows)) / F.col("n_rows"))
        found = hits.groupBy("id").agg(
            F.count("*").alias("n_terms"), F.round(F.sum(F.col("times") * weight), 4).alias("score")
        )
        if mode == "all":
            found = found.where(F.col("n_terms") == len(terms))
        return found if k is None else found.orderBy(F.desc("score"), "id").limit(k)
