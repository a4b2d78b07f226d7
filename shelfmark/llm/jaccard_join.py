"""Exact Jaccard self-join of documents' word n-grams by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.components import components
from shelfmark.llm.spans import mix, shingle_set
from shelfmark.session import hand_over

_SIGS = "sig bigint, n int, head bigint, members array<bigint>"
# documents, and shingles, of a block; two blocks are compared in one task
BLOCK, BLOCK_SHINGLES = 1000, 2_000_000
BROADCAST_ROWS = 1_000_000  # of 30 bytes each
# of few bits, as most of what is shuffled are signatures; what meets by chance is compared too
SIGNATURE = np.uint64((1 << 48) - 1)


class Scheme:
    """Size bands, and what each band's signatures look like, for a threshold of percent / 100.

    Band j holds the sizes from ``low[j]`` to ``high[j]``; sets whose sizes lie more than one
    band apart cannot reach the threshold. Instance j serves the pairs within band j and between
    bands j - 1 and j: those differ in at most ``k`` elements.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.high = [1], [100 // percent]

    def band(self, n: int) -> int:
        while self.high[-1] < n:
            self.low.append(self.high[-1] + 1)
            self.high.append(self.low[-1] * 100 // self.percent)
        return int(np.searchsorted(self.high, n))

    def most_apart(self, a: int, b: int) -> int:
        """Elements in one of two sets of these sizes only, at most, if they reach the threshold."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def shape(self, j: int) -> tuple[int, int, int, int]:
        """(n1, n2, k2, spare) of instance j.

        The hash range is cut into n1 parts of n2 cells. Of two sets that differ in k elements at
        least ``spare`` parts differ in at most k2 cells, so in each of them some choice of
        n2 - k2 cells is the same in both. Small k have one part and more choices.
        """
        self.band(self.high[-1] if j < len(self.high) else self.high[-1] + 1)
        k = self.most_apart(self.high[j], self.high[j])
        if k == 0:
            return 1, 1, 0, 1
        if k <= 3:
            return 1, k + 3, k, 1
        spare = 3 + k // 30
        return k // 2 + spare, 3, 1, spare

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """Signatures of a sorted set in its own instance and the next.

        A choice of cells in which a set has no element says little, and yet two near sets may
        agree in nothing else: but then both have such choices in ``spare`` parts at least, the
        same ones. So only sets with as many give signatures of empty choices, and where there
        are three parts to spare, of three parts at once: any two such sets share one of those
        among the first of their parts (all but ``spare - 3``).
        """
        if not len(elements):
            return elements
        j = self.band(len(elements))
        self.band(self.high[j] + 1)
        sums = np.zeros(len(elements) + 1, np.uint64)
        np.cumsum(mix(elements), out=sums[1:])
        found = []
        for i in (j, j + 1):
            n1, n2, k2, spare = self.shape(i)
            cells = n1 * n2
            edges = (np.arange(1, cells, dtype=np.float64) * (2.0**64 / cells)).astype(np.uint64)
            at = np.r_[0, np.searchsorted(elements, edges), len(elements)]
            counts = np.diff(at).reshape(n1, n2)
            totals = (sums[at[1:]] - sums[at[:-1]]).reshape(n1, n2)
            pick = _choices(n2, n2 - k2)
            sizes = counts @ pick
            sigs = totals @ pick.astype(np.uint64)
            names = np.arange(sigs.size, dtype=np.uint64).reshape(sigs.shape)
            sigs = mix(mix(sigs + np.uint64(i + 1)) + names)
            empty = sizes == 0
            found.append(sigs[~empty] & SIGNATURE)
            parts = np.flatnonzero(empty.any(axis=1))
            if len(parts) >= spare:
                together = min(spare, 3)
                first = parts[: len(parts) - spare + together].tolist()
                rows = [
                    [names[p][empty[p]].tolist() for p in chosen]
                    for chosen in combinations(first, together)
                ]
                choices = [c for row in rows for c in product(*row)]
                numbers = np.array(choices, np.uint64)
                mixed = np.full(len(numbers), np.uint64(i + 1))
                for column in numbers.T:
                    mixed = mix(mixed * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1))
                found.append(mixed & SIGNATURE)
        return np.concatenate(found)


@cache
def _choices(n: int, size: int) -> np.ndarray:
    """Columns of 0 and 1: all ways to choose ``size`` of ``n`` cells."""
    masks = np.arange(1 << n)[:, None] >> np.arange(n) & 1
    chosen = masks[masks.sum(axis=1) == size].T
    assert chosen.shape[1] == comb(n, size)
    return chosen


def set_key(elements: np.ndarray) -> np.int64:
    """A hash of a set, the same for equal sets."""
    total = mix(elements).sum(dtype=np.uint64) + np.uint64(len(elements))
    return mix(np.array([total])).view(np.int64)[0]


def _batch(sig: np.ndarray, n: pa.Array, head: pa.Array, members: pa.Array) -> pa.RecordBatch:
    arrays = [pa.array(sig.view(np.int64)), n, head, members]
    return pa.RecordBatch.from_arrays(arrays, ["sig", "n", "head", "members"])


def _signature_rows(percent: int, words: int):  # noqa: ANN202
    scheme = Scheme(percent)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("doc_id")
            sets = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            keys = np.array([set_key(x) for x in sets], np.int64)
            number = np.arange(len(sets), dtype=np.uint64)
            sizes = pa.array(np.array([len(x) for x in sets], np.int32))
            of_text = np.c_[keys, batch.column("t").to_numpy()].ravel()
            places = pa.array(np.arange(0, 2 * len(sets) + 1, 2, dtype=np.int32))
            yield _batch(mix(number), sizes, given, pa.ListArray.from_arrays(places, pa.array(of_text)))

            known = given.is_valid().to_numpy(zero_copy_only=False)
            first = {keys[i]: i for i in np.flatnonzero(known) if len(sets[i])}
            found = [scheme.signatures(sets[i]) for i in first.values()]
            owner = np.repeat(np.array(list(first), np.int64), [len(f) for f in found])
            sigs = np.concatenate([*found, np.zeros(0, np.uint64)])
            # one row per signature of a batch: its first set, and all if it has several
            order = np.lexsort((owner, sigs))
            sigs, owner = sigs[order], owner[order]
            start = np.flatnonzero(np.r_[True, sigs[1:] != sigs[:-1]][: len(sigs)])
            size = np.diff(np.r_[start, len(sigs)])
            several = size > 1
            offsets = np.r_[0, np.cumsum(np.where(several, size, 0))].astype(np.int32)
            members = pa.ListArray.from_arrays(
                pa.array(offsets, mask=np.r_[~several, False]), pa.array(owner[np.repeat(several, size)])
            )
            rows = _batch(sigs[start], pa.nulls(len(start), pa.int32()), pa.array(owner[start]), members)
            # equal heads side by side are compressed best
            yield rows.take(pa.array(np.argsort(owner[start], kind="stable")))

    return rows


def _met(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Rows (a, b, n, t): document a has a text of hash t, whose set has the key b and n elements;
    or, without n and t, the key b of a set and the smallest key a of a signature both have.
    """
    by_sig = Window.partitionBy("sig", "n")
    is_pair = F.col("n").isNull()
    met = (
        docs.mapInArrow(_signature_rows(percent, words), _SIGS)
        .withColumn("a", F.when(is_pair, F.min("head").over(by_sig)).otherwise(F.col("head")))
        .withColumn("rows", F.count("*").over(by_sig))
        .where("n is not null or rows > 1 or members is not null")
        .withColumn("t", F.when(~is_pair, F.get("members", F.lit(1))))
        .withColumn("members", F.when(is_pair, F.col("members")).otherwise(F.slice("members", 1, 1)))
        .withColumn("b", F.explode(F.coalesce("members", F.array("head"))))
        .where("n is not null or b <> a")
        .select("a", "b", "n", "t")
    )
    return hand_over(met, "met")


def shared_counts(tokens: list[np.ndarray], a: np.ndarray, b: np.ndarray, width: int = 2048) -> np.ndarray:
    """How many elements every set of ``a`` shares with every set of ``b`` (indices)."""
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    _, column, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    often = np.flatnonzero(counts > 1)  # others are shared with nobody
    rank = np.full(len(counts), -1)
    rank[often] = np.arange(len(often))
    column = rank[column]
    found = np.zeros((len(a), len(b)), np.float32)
    for low in range(0, len(often), width):
        inside = (column >= low) & (column < low + width)
        table = np.zeros((len(tokens), min(width, len(often) - low)), np.float32)
        table[owner[inside], column[inside] - low] = 1
        found += table[a] @ table[b].T
    return found


def spanning_edges(ids: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join the same vertices as the symmetric matrix ``linked`` does."""
    left, edges = np.ones(len(ids), bool), []
    for start in range(len(ids)):
        if not left[start]:
            continue
        left[start] = False
        reached = [start]
        while reached:
            new = np.flatnonzero(linked[reached.pop()] & left)
            left[new] = False
            reached.extend(new.tolist())
            edges.extend((int(ids[start]), int(ids[k])) for k in new)
    return edges


def _placed(pairs: DataFrame, sets: DataFrame, count: bool) -> DataFrame:
    """Where every set that shares a signature is compared: rows (key, doc_id, t, copies, earlier,
    cluster, own, first, second). ``earlier`` are the set's smaller clusters, if links are counted.

    A cluster is a set and all that share a signature of which it is the smallest; so all
    sets of a signature are in one cluster, and chains of chance meetings join nothing. A
    cluster is cut in blocks of about ``BLOCK`` sets, or fewer long ones, by a hash; a
    set goes to every pair of blocks that has its own.
    """
    clusters = hand_over(
        pairs.select(F.col("b").alias("key"), F.col("a").alias("cluster"))
        .unionByName(pairs.select(F.col("a").alias("key"), F.col("a").alias("cluster")))
        .distinct(),
        "clusters",
    )
    found = clusters.join(sets, "key")
    blocks = (
        found.groupBy("cluster")
        .agg(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
        .withColumn("blocks", F.ceil("blocks").cast("int"))
    )
    earlier = F.array().cast("array<bigint>")
    if count:
        lists = clusters.groupBy("key").agg(F.collect_list("cluster").alias("all"))
        found = found.join(lists, "key")
        earlier = F.filter("all", lambda c: c < F.col("cluster"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = (
        found.withColumn("earlier", earlier)
        .join(blocks, "cluster")
        .withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", other)
    )
    first, second = F.least("own", "other"), F.greatest("own", "other")
    return hand_over(
        placed.select("key", "doc_id", "t", "copies", "earlier", "cluster", "own", first.alias("first"), second.alias("second")),
        "placed",
    )


def _links(placed: DataFrame, docs: DataFrame, percent: int, words: int, count: bool) -> DataFrame:
    """Links (a, b) of documents within the clusters, as a spanning forest of every two blocks;
    and rows (a, null, n): the set of key a is linked with the sets of n documents. Two sets are
    counted in the least cluster both are in.

    What is shuffled grows with the sets times their cluster's blocks, and what a task
    returns with its sets; pairs are only ever counted inside a task.
    """

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("key").sort_values("key", ignore_index=True)
        own, first, second = pdf["own"], pdf["first"].iloc[0], pdf["second"].iloc[0]
        a, b = np.flatnonzero(own == first), np.flatnonzero(own == second)
        rows: list[tuple[int, int | None, int | None]] = []
        if len(pdf) > 1 and len(a) and len(b):
            sets = [shingle_set(t, words) for t in pdf["text"]]
            size = np.array([len(x) for x in sets], np.int64)
            shared = shared_counts(sets, a, b).astype(np.int64)
            union = size[a][:, None] + size[b][None, :] - shared
            near = (shared > 0) & (100 * shared >= percent * union) & (a[:, None] != b[None, :])
            linked = np.zeros((len(pdf), len(pdf)), bool)
            linked[np.ix_(a, b)] = near
            rows = [(x, y, None) for x, y in spanning_edges(pdf["doc_id"].to_numpy(), linked | linked.T)]
            if count:
                earlier = [np.asarray(x, np.int64) for x in pdf["earlier"]]
                near &= shared_counts(earlier, a, b) == 0
                copies, keys = pdf["copies"].to_numpy(), pdf["key"].to_numpy()
                ends = [(a, near @ copies[b])] + ([(b, copies[a] @ near)] if first != second else [])
                rows += [(int(keys[i]), None, int(n)) for of, ns in ends for i, n in zip(of, ns, strict=True) if n]
        return pd.DataFrame(rows, columns=["a", "b", "n"], dtype="object").astype("Int64")

    read = docs.withColumnsRenamed({"doc_id": "d_id", "t": "d_t"})
    # else the texts are shuffled to meet their places
    longs = placed.agg(F.sum(F.size("earlier") + 8)).first()[0] or 0
    if longs <= 8 * BROADCAST_ROWS:
        placed = F.broadcast(placed)
    found = (
        read.join(placed, (F.col("d_id") == F.col("doc_id")) & (F.col("d_t") == F.col("t")))
        .drop("d_id", "d_t")
        .groupBy("cluster", "first", "second")
        .applyInPandas(compare, "a bigint, b bigint, n bigint")
    )
    return hand_over(found, "links") if count else found


def linked_components(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 4,
    percent: int = 85,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, see ``linked_documents``."""
    found = _linked(df, doc_id, text, words, percent, count=False)
    return found.select("doc_id", "n_shingles", "component_id")


def linked_documents(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 4,
    percent: int = 85,
) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of every row: documents whose sets of
    ``words``-word shingles have a Jaccard similarity of ``percent`` / 100 or more are linked.

    component_id is the smallest id reachable by links. It is exact for every threshold, but the
    number of signatures rises steeply below 75 percent. Words are what stands between blanks,
    A-Z lower-cased; a text of fewer words is one shingle. The join is exact but for collisions
    of 64-bit hashes of shingles and sets.

    n_links is the number of other documents the row's text is linked with; a document counts once
    for each of its different sets that is linked, another set of the row's own id too.

    1. Every set gives PartEnum signatures (see ``Scheme``): sets that may be linked share one.
       Equal sets are one, known by a hash, and counted as often as documents have it; a signature
       is one row for all its sets that are read together, so a hot one is combined before the
       shuffle.
    2. Of a signature only the pairs with its smallest set are written; that set and
       all it is paired with are a cluster.
    3. Clusters are compared in blocks, which return a forest of links and the number of links of
       every set (see ``_placed``, ``_links``).
    4. Components are found over all links.

    Null, empty and blank texts have no shingle and are linked with nothing; rows without id get
    no component and no links. Rows of one id are one document with the links of all its texts in
    its component. Repeated rows give repeated results. An empty table gives an empty result;
    other columns are ignored.
    """
    return _linked(df, doc_id, text, words, percent, count=True)


def _linked(df: DataFrame, doc_id: str, text: str, words: int, percent: int, count: bool) -> DataFrame:
    docs = df.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("t"),
    )
    met = _met(docs, percent, words)
    rows = met.where("n is not null").select(
        F.col("a").alias("doc_id"), F.col("b").alias("key"), F.col("n").cast("bigint").alias("n_shingles"), "t"
    )
    owned = (
        rows.where("doc_id is not null and n_shingles > 0")
        .groupBy("key", "doc_id")
        .agg(F.min("t").alias("t"), F.max("n_shingles").alias("n"))
    )
    sets = hand_over(
        owned.groupBy("key")
        .agg(F.min(F.struct("doc_id", "t")).alias("least"), F.max("n").alias("n"), F.count("*").alias("copies"))
        .select("key", "least.*", "n", "copies"),
        "sets",
    )
    equal = (
        rows.where("doc_id is not null")
        .join(sets.where("copies > 1").select("key", F.col("doc_id").alias("a")), "key")
        .select("a", F.col("doc_id").alias("b"))
        .where("a <> b")
    )
    pairs = met.where("n is null").select("a", "b").distinct()
    links = _links(_placed(pairs, sets, count), docs, percent, words, count)
    found = components(equal.unionByName(links.where("b is not null").select("a", "b")))
    own = F.when(F.col("n_shingles") > 0, F.col("component"))
    result = rows.join(found.withColumnRenamed("v", "doc_id"), "doc_id", "left")
    if count:
        counted = (
            sets.select("key", F.col("copies").alias("n"))
            .unionByName(links.where("b is null").select(F.col("a").alias("key"), "n"))
            .groupBy("key")
            .agg((F.sum("n") - 1).alias("links"))
        )
        result = result.join(counted, "key", "left")
    else:
        result = result.withColumn("links", F.lit(None).cast("bigint"))
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0).cast("bigint")))
    return result.select(
        "doc_id", "n_shingles", n_links.alias("n_links"), F.coalesce(own, "doc_id").alias("component_id")
    )
