"""Benchmark decontamination: item-sized windows of documents that repeat a benchmark item."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import lower_ascii, words
from shelfmark.session import hand_over

BITS, BLOCKS = 64, 4
WIDTH = BITS // BLOCKS
# so many bits of a block are turned on the side of the windows and of the items; two fingerprints of which
# every block differs in more bits than both are further apart than the radius
WINDOW_BITS, ITEM_BITS = 1, 2
RADIUS = (WINDOW_BITS + ITEM_BITS + 1) * BLOCKS - 1
# independent fingerprints; one within the radius is enough
PRINTS = 4


def shingles(tokens: Column, size: Column, k: int) -> Column:
    """Hashes of the ``k``-word shingles at every position of an array of ``size`` words."""
    starts = F.sequence(F.lit(0), size - k)

    def one(at: Column) -> Column:
        return F.xxhash64(*[F.get(tokens, at + i) for i in range(k)])

    none = F.array().cast("array<bigint>")
    return F.when(size >= k, F.transform(starts, one)).otherwise(none)


def fingerprint(df: DataFrame, tokens: str, name: str, seed: int = 0) -> DataFrame:
    """Adds the 64-bit SimHash of the words in the array ``tokens``: a bit is set if it is in
    most of the words' hashes, a word counted as often as it stands there. Every ``seed`` gives
    other hashes.
    """
    one = F.lit(1).cast("bigint")

    def add(value: Column, bit: Column) -> Column:
        ones = F.size(F.filter("hashes", lambda h: F.call_function("getbit", h, bit) == 1))
        set_bit = F.call_function("shiftleft", one, bit)
        return value.bitwiseOR(F.when(2 * ones > F.size("hashes"), set_bit).otherwise(F.lit(0)))

    value = F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), add)
    hashes = F.transform(tokens, lambda w: F.xxhash64(F.lit(seed), w) if seed else F.xxhash64(w))
    return df.withColumn("hashes", hashes).withColumn(name, value).drop("hashes")


def fingerprints(df: DataFrame, tokens: str, name: str) -> DataFrame:
    """Adds an array of ``PRINTS`` SimHashes with different seeds."""
    parts = [f"{name}_{seed}" for seed in range(PRINTS)]
    for seed, part in enumerate(parts):
        df = fingerprint(df, tokens, part, seed)
    return df.withColumn(name, F.array(*parts)).drop(*parts)


def block(value: Column, i: Column) -> Column:
    """Block ``i`` of a fingerprint."""
    shifted = F.call_function("shiftrightunsigned", value, i * WIDTH)
    return shifted.bitwiseAND(F.lit((1 << WIDTH) - 1))


def index_items(benchmark: DataFrame, k: int) -> DataFrame:
    """Items (item_id, length, n, item words, shingles, fingerprints); those without a word are
    left out. An item of fewer than ``k`` words is one shingle of n words.
    """
    cut = benchmark.select("item_id", words(lower_ascii(F.col("text"))).alias("item"))
    cut = cut.withColumn("length", F.size("item")).where("length > 0").distinct()
    cut = fingerprints(cut, "item", "item_prints")
    parts = [
        cut.where(F.col("length") >= k if n == k else F.col("length") == n)
        .withColumn("n", F.lit(n))
        .withColumn("item_shingles", shingles(F.col("item"), F.col("length"), n))
        for n in range(1, k + 1)
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def turns(bits: int) -> Column:
    """All masks with at most ``bits`` bits of a block set."""
    masks = [sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(WIDTH), n)]
    return F.array(*[F.lit(m).cast("bigint") for m in masks])


def _blocks_of(df: DataFrame, key: str, prints: str, bits: int) -> DataFrame:
    """(key, length, p, i, value, print): every block of every fingerprint, as it is and with up to
    ``bits`` bits turned over.
    """
    return (
        df.select(key, "length", F.posexplode(prints).alias("p", "print"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
        .withColumn("turn", F.explode(turns(bits)))
        .withColumn("value", block(F.col("print"), F.col("i")).bitwiseXOR(F.col("turn")))
        .drop("turn")
    )


def proposed(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(window, item_no): the pairs of one length of which a block of a fingerprint agrees but for
    ``WINDOW_BITS + ITEM_BITS`` bits; several times if several do. With ``print`` of both sides.
    """
    blocks = hand_over(_blocks_of(items, "item_no", "item_prints", ITEM_BITS), "item-blocks")
    blocks = blocks.withColumnRenamed("print", "item_print")
    return _blocks_of(windows, "window", "prints", WINDOW_BITS).join(blocks, ["length", "p", "i", "value"])


def near_pairs(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(window, item_no) of one length that have a fingerprint within the radius; no words travel."""
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    return proposed(windows, items).where(apart <= RADIUS).select("window", "item_no").distinct()


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles, a shingle weighing as often as it
    occurs.
    """

    def times(of: Column, s: Column) -> Column:
        return F.size(F.filter(of, lambda x: x == s))

    shared = F.array_intersect(a, b)
    # if one of them repeats nothing, every shingle counts once
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    both = F.when(once, F.size(shared)).otherwise(
        F.aggregate(shared, F.lit(0), lambda n, s: n + F.least(times(a, s), times(b, s)))
    )
    return both / (F.size(a) + F.size(b) - both)


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    k: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """(doc_id, item_id, start, length, similarity): the best window for every item that a
    document repeats. Documents that repeat none do not appear.

    Words are lower-cased (A-Z). A window has as many words as the item, or the whole document
    if that has fewer, and starts at any word; only windows with too few shingles of items of
    their length to reach the threshold are left out. Every window gets four 64-bit SimHashes
    of its words, with different hashes. It meets the items of its length that agree in one of 4
    blocks of 16 bits of one of them up to three bits, one of them turned on the side of the window and two on
    that of the item, which finds all that have a fingerprint no more than 15 bits apart, and a sixth
    of all others. Those within the radius are put together with their words, and the weighted
    Jaccard similarity of the shingles decides. A window at a similarity of 0.8 has a given fingerprint
    further away in up to 3 of 100 cases, all four in less than 1 of 100,000. Of equally similar
    windows the first is returned.

    The table of item shingles is written first, so Spark knows its size and broadcasts it only
    if that is small; else documents' shingles are shuffled as (hash, id, position). Whole texts
    are read twice and joined with their windows once.

    Null and blank texts and items repeat nothing; rows without an id come back with a null id;
    repeated rows of documents or items give one result. Empty tables give an empty result; other
    columns are ignored.
    """
    items = hand_over(index_items(benchmark, k).withColumn("item_no", F.monotonically_increasing_id()), "items")
    known = hand_over(
        items.select("length", "n", F.explode("item_shingles").alias("shingle")).distinct(),
        "item-shingles",
    )
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"))
    docs = docs.withColumn("t", F.xxhash64("text"))
    cut = docs.select("doc_id", "t", words(lower_ascii(F.col("text"))).alias("w"))
    cut = cut.withColumn("size", F.size("w"))
    sizes = sorted(r["n"] for r in items.select("n").distinct().collect())  # k at most
    found = None
    for n in sizes:
        part = (
            cut.select("doc_id", "t", "size", F.posexplode(shingles(F.col("w"), F.col("size"), n)).alias("pos", "shingle"))
            .join(known.where(F.col("n") == n), "shingle")
            .select("doc_id", "t", "size", "length", "n", "pos")
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        return _nothing(df, doc_id, benchmark)
    windows = hand_over(
        found.groupBy(F.col("doc_id").alias("w_id"), F.col("t").alias("w_t"), "size", "length", "n")
        .agg(F.array_sort(F.collect_set("pos")).alias("at"))
        .withColumn("start", F.explode(_starts(threshold)))
        .groupBy("w_id", "w_t")
        .agg(F.collect_list(F.struct("length", "n", "start")).alias("windows")),
        "windows",
    )
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("t") == F.col("w_t"))
    read = (
        docs.join(windows, same)
        .select("doc_id", "windows", words(lower_ascii(F.col("text"))).alias("w"))
        .select("doc_id", "w", F.explode("windows").alias("at"))
        .select("doc_id", "at.*", F.slice("w", F.col("at.start") + 1, F.col("at.length")).alias("words"))
        .distinct()
        .repartition(F.xxhash64("doc_id", "start", "length"))  # few bytes, but much work a row
    )
    read = hand_over(
        fingerprints(read, "words", "prints").withColumn("window", F.monotonically_increasing_id()), "windows-read"
    )
    size = F.size("words")
    own = F.lit(None).cast("array<bigint>")
    for n in sizes:
        own = F.when(F.col("n") == n, shingles(F.col("words"), size, n)).otherwise(own)
    pairs = (
        near_pairs(read, items)
        .join(read.select("window", "doc_id", "start", "length", "n", "words"), "window")
        .join(items.select("item_no", "item_id", "item_shingles"), "item_no")
    )
    best = F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("s"), "length"))
    return (
        pairs.withColumn("own", own)
        .withColumn("similarity", similarity(F.col("own"), F.col("item_shingles")))
        .where(F.col("similarity") >= threshold)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            (-F.col("best.s")).alias("start"),
            F.col("best.length").alias("length"),
            F.col("best.similarity").alias("similarity"),
        )
    )


def _starts(threshold: float) -> Column:
    """First words of the windows of ``length`` in a document of ``size`` words that can reach the
    threshold, ``at`` being the sorted positions of the shingles that some item of that length has.

    A similar window holds ``need`` of these positions at least. Those that hold ``need`` of them
    from the one numbered i on start in a range; ranges only move on with i, so what the range
    before has is left out.
    """
    cut = F.least("length", "size")
    last = F.col("size") - cut
    both = (F.col("length") + cut - 2 * F.col("n") + 2) * F.lit(threshold / (1 + threshold))
    need = F.greatest(F.ceil(both - 1e-6).cast("int"), F.lit(1))

    def starts(i: Column) -> Column:
        low = F.greatest(F.get("at", i + need - 1) - cut + F.col("n"), F.lit(0))
        low = F.when(i > 0, F.greatest(low, F.least(F.get("at", i - 1), last) + 1)).otherwise(low)
        high = F.least(F.get("at", i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    none = F.array().cast("array<int>")
    numbers = F.sequence(F.lit(0), F.size("at") - need)
    return F.when(F.size("at") >= need, F.flatten(F.transform(numbers, starts))).otherwise(none)


def _nothing(df: DataFrame, doc_id: str, benchmark: DataFrame) -> DataFrame:
    spark: SparkSession = df.sparkSession
    ids = f"doc_id {df.schema[doc_id].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}"
    return spark.createDataFrame([], f"{ids}, start int, length int, similarity double")
