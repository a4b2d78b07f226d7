"""Exact search for the largest inner products, by buckets of vectors of similar length."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import hand_over

# vectors of a bucket and of a block of queries, fewer if they have very many components
BUCKET = 4_096
QUERIES = 2_048
VALUES = 1 << 22
# from this cosine on a bucket is pruned by coordinates, below it by length
COORDINATE_FROM = 0.7
FOCUS = 3
LONGEST = 2**63 - 1
_PARTITION_BITS = 33  # monotonically_increasing_id keeps the position in its low 33 bits
_SLACK = 1e-9  # bounds are in floating point, products are exact


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with 0."""
    lists = vectors.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), np.int64)
    found[np.arange(width) < sizes[:, None]] = values
    return found


def _widened(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def _largest(m: np.ndarray) -> float:
    return float(np.abs(m.astype(np.float64)).max(initial=0))


class _Products:
    """Exact integer products of queries and candidates: in floating point where every sum is below
    2 ** 53, else with integers of any size, cut to the range of a long.
    """

    def __init__(self, queries: np.ndarray, others: np.ndarray):
        self.exact = _largest(queries) * _largest(others) * queries.shape[1] < 2**53
        kind = np.float64 if self.exact else object
        self.queries, self.others = queries.astype(kind), others.astype(kind)

    def of(self, query: np.ndarray | int, others: slice | np.ndarray) -> np.ndarray:
        if not self.queries.shape[1]:
            shape = self.queries[query].shape[:-1] + self.others[others].shape[:1]
            return np.zeros(shape, np.int64)
        found = self.queries[query] @ self.others[others].T
        return (found if self.exact else np.clip(found, -LONGEST - 1, LONGEST)).astype(np.int64)


def _units(m: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return m.astype(np.float64) / np.where(norms > 0, norms, 1.0)[:, None]


def coordinate_candidates(unit: np.ndarray, units: np.ndarray, cosine: float) -> np.ndarray:
    """Rows of ``units`` whose coordinates allow a cosine of at least ``cosine`` with ``unit``: in
    each of its largest coordinates they lie within the angle around it.
    """
    rows = np.arange(len(units))
    reach = math.acos(min(1.0, cosine))
    for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
        angle = math.acos(max(-1.0, min(1.0, unit[f])))
        low = math.cos(min(math.pi, angle + reach)) - _SLACK
        high = math.cos(max(0.0, angle - reach)) + _SLACK
        at = units[rows, f]
        rows = rows[(at >= low) & (at <= high)]
    return rows


def search_bucket(queries: pa.Table, bucket: pa.Table, k: int) -> list[tuple[int, int, int]]:
    """(number of the query, number of the candidate, score) of the ``k`` best of one bucket for each
    query, of those that reach the query's ``least`` score, if it has one. The bucket is in order of
    falling length.

    The local threshold of a query is the cosine that the longest vector of the bucket would need for
    ``least``. Above 1 the bucket has nothing. Close to 1 few vectors have coordinates that allow
    it, and those are verified; else the vectors long enough for ``least`` are.
    """
    q, p = _matrix(queries["v"]), _matrix(bucket["v"])
    width = max(q.shape[1], p.shape[1])
    q, p = _widened(q, width), _widened(p, width)
    q_norm, p_norm = queries["norm"].to_numpy(), bucket["norm"].to_numpy()
    q_row, p_row = queries["row"].to_numpy(), bucket["row"].to_numpy()
    ids = bucket["id"].combine_chunks()
    # the place among all ids of the bucket in rising order, null last
    place = np.empty(len(p), np.int64)
    place[pa.compute.sort_indices(ids).to_numpy()] = np.arange(len(p))
    least = queries["least"].combine_chunks()
    bounded = np.array(least.is_valid()) & (q_norm > 0)
    floor = np.array(least.fill_null(0), dtype=np.int64)
    reach = np.where(bounded, floor / np.where(q_norm > 0, q_norm, 1.0), -np.inf)
    longest = p_norm.max(initial=0.0)
    cosine = np.where(bounded & (floor > 0), reach / longest if longest > 0 else np.inf, -1.0)
    products = _Products(q, p)
    units = None
    found: list[tuple[int, int, int]] = []

    def take(i: int, rows: np.ndarray, scores: np.ndarray) -> None:
        keep = p_row[rows] != q_row[i]
        if bounded[i]:
            keep &= scores >= floor[i]
        rows, scores = rows[keep], scores[keep]
        if len(rows) > k:
            near = scores >= np.partition(scores, -k)[-k]
            rows, scores = rows[near], scores[near]
        best = np.lexsort((place[rows], -scores))[:k]
        found.extend((int(i), int(r), int(s)) for r, s in zip(rows[best], scores[best], strict=True))

    by_length = []
    for i in np.flatnonzero(cosine <= 1 + _SLACK):
        if cosine[i] < COORDINATE_FROM:
            by_length.append(i)
            continue
        if units is None:
            units = _units(p, p_norm)
        rows = coordinate_candidates(q[i] / q_norm[i], units, cosine[i] - _SLACK)
        take(i, rows, products.of(int(i), rows))
    # how many vectors are long enough; queries that ask for as many go together
    enough = np.searchsorted(-p_norm, -reach * (1 - np.sign(reach) * _SLACK), "right")
    by_length = sorted(by_length, key=lambda i: enough[i])
    for s in range(0, len(by_length), 256):
        part = by_length[s : s + 256]
        scores = products.of(np.array(part), slice(0, int(enough[part].max())))
        for i, row in zip(part, scores, strict=True):
            take(i, np.arange(enough[i]), row[: enough[i]])
    return found


def _searched(pairs: DataFrame, rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best of each (block, bucket) of ``pairs`` for each query of the block."""
    columns = ["block", "bucket", "row", "id", "v", "norm", "least", "asks"]
    a = rows.join(pairs, "bucket").withColumns({"least": F.lit(None).cast("bigint"), "asks": F.lit(False)})
    b = queries.join(pairs, "block").withColumn("asks", F.lit(True))
    ids = rows.schema["id"].dataType.simpleString()

    def search(table: pa.Table) -> pa.Table:
        asks = table["asks"]
        asked = table.filter(asks)
        bucket = table.filter(pa.compute.invert(asks)).sort_by([("norm", "descending"), ("row", "ascending")])
        found = search_bucket(asked, bucket, k) if asked.num_rows and bucket.num_rows else []
        q, p, scores = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [])))
        return pa.table(
            {
                "query": asked["row"].take(q),
                "query_id": asked["id"].take(q),
                "found_id": bucket["id"].take(p),
                "score": pa.array(scores),
            }
        )

    both = a.select(*columns).unionByName(b.select(*columns))
    schema = f"query bigint, query_id {ids}, found_id {ids}, score bigint"
    return both.groupBy("block", "bucket").applyInArrow(search, schema)


def top_products(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "vector",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``df`` for which ``is_query`` holds the ``k``
    rows with the largest inner product of their integer vectors, all if there are fewer.

    Every other row is a candidate. Ties go to the smaller id, null last, and equal rows share them.
    ``vector`` holds whole numbers; rows whose vector is null or holds a null take no part, a
    shorter vector is filled up with 0, products beyond the range of a long are cut to it. Repeated rows
    are rows of their own, also as queries. An empty table gives an empty result.

    Rows are sorted by length over range partitions and cut in buckets. Queries, in blocks, search
    the first buckets, and the score of the k-th found bounds what another bucket must
    offer: only buckets with a vector long enough for some query of a block meet the block (see
    ``search_bucket`` for what is pruned inside). A task holds one bucket and one block.
    """
    numbers = F.col(f"`{vector}`").cast("array<bigint>")
    valid = numbers.isNotNull() & F.forall(numbers, lambda x: x.isNotNull())
    squares = F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = df.select(
        F.col(f"`{vec_id}`").alias("id"),
        numbers.alias("v"),
        F.sqrt(squares).alias("norm"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
        # equal rows, however many, can so be cut over several ranges; files give the same numbers again
        F.monotonically_increasing_id().alias("given"),
    ).where(valid)
    order = [F.desc("norm"), F.col("id"), F.col("given")]
    placed = hand_over(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("given").withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    known = placed.agg(F.max(F.size("v")), F.sum(F.col("q").cast("bigint"))).first()
    width, asked = max(1, known[0] or 0), known[1] or 0
    in_bucket, in_block = (max(1, min(most, VALUES // width)) for most in (BUCKET, QUERIES))
    blocks = max(1, math.ceil(asked / in_block))
    position = F.col("row").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    placed = placed.withColumn(
        "bucket",
        F.shiftleft(F.shiftright("row", _PARTITION_BITS), 32) + F.floor(position / in_bucket),
    )
    queries = placed.where("q").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    rows = placed.select("bucket", "row", "id", "v", "norm")
    buckets = placed.groupBy("bucket").agg(F.max("norm").alias("longest"), F.count("*").alias("rows"))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    # the first buckets, enough for k candidates; usually one
    heads, filled = [], 0
    for b in buckets.orderBy("bucket").limit(k + 1).collect():
        if filled <= k:
            heads.append(b["bucket"])
            filled += b["rows"]
    is_head = F.col("bucket").isin(heads)
    no_bound = queries.select("block", "row", "id", "v", "norm", F.lit(None).cast("bigint").alias("least"))
    head_pairs = buckets.where(is_head).select("bucket", every_block)
    head = hand_over(_searched(head_pairs, rows.where(is_head), no_bound, k), "first-found")
    bounds = head.groupBy("query").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    bounds = bounds.select(F.col("query").alias("row"), F.get("s", F.lit(k - 1)).alias("least"))
    bounded = hand_over(
        queries.join(bounds, "row", "left").select("block", "row", "id", "v", "norm", "least"), "queries"
    )
    # the length that a candidate must have at least for some query of the block
    needs = bounded.groupBy("block").agg(
        F.min(F.when(F.col("least").isNull() | (F.col("norm") == 0), F.lit(0.0)).otherwise(F.col("least") / F.col("norm"))).alias("need")
    )
    pairs = (
        buckets.where(~is_head)
        .select("bucket", "longest", every_block)
        .join(needs, "block")
        .where(F.col("need") <= F.col("longest") * (1 + _SLACK))
        .select("bucket", "block")
    )
    found = head.unionByName(_searched(pairs, rows.where(~is_head), bounded, k))
    per_query = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("found_id"))
    best = F.row_number().over(per_query).alias("rank")
    return (
        found.select("query_id", "query", F.col("found_id").alias("vec_id"), "score", best)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
