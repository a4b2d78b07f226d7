"""Quality rules: statistics of a text, and an isolation forest that finds the odd ones."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import ROW, nest, unnest
from shelfmark.llm.spans import BLANK, hash_runs, joined, raw_bytes, runs
from shelfmark.session import hand_over

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_STATS = T.StructType([T.StructField(c, T.LongType()) for c in BASE])


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of five found twice or more, the first find included."""
    windows = joined(words, WINDOW)
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    found = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    covered[found] += 1
    covered[found + WINDOW] -= 1
    return int((np.cumsum(covered[:-1]) > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The base statistics; all are 0 for a null or blank text. Words and lines are compared by
    64-bit hashes.
    """
    raw = raw_bytes(text)
    inside = ~BLANK[raw]
    starts, ends = runs(inside)
    if not len(starts):
        return (0,) * len(BASE)
    breaks = np.flatnonzero(raw == ord("\n"))
    first, last = np.r_[0, breaks + 1], np.r_[breaks, len(raw)]
    worded = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    spans = hash_runs(raw, np.r_[starts, first[worded]], np.r_[ends, last[worded]])
    words, lines = spans[: len(starts)], spans[len(starts) :]
    return (
        len(words),
        int((inside & ((raw & 0xC0) != 0x80)).sum()),
        int(SYMBOLS[raw].sum()),
        len(lines) - len(np.unique(lines)),
        repeated_words(words),
    )


@F.pandas_udf(_STATS)
def _stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in texts], columns=BASE)


def features(stats: pd.DataFrame) -> np.ndarray:
    """What the base rules leave open: mean word length and symbols per word, as logarithms.

    Both are shares, so they do not depend on the length of a text. Repeats are judged by a base
    rule already; among good documents they vary so much that they would hide the rest.
    """
    words = np.maximum(stats["n_words"].to_numpy(float), 1)
    shares = [stats["word_chars"].to_numpy(float), stats["n_symbols"].to_numpy(float)]
    return np.log1p(20 * np.column_stack(shares) / words[:, None])


def _path_of(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_tree(x: np.ndarray, seed: int) -> list[list[float]]:
    """Random splits until rows stand alone: nodes of (feature, cut, left, right, path)."""
    rng = np.random.default_rng(seed)
    most = max(1, int(np.ceil(np.log2(max(len(x), 2)))))
    nodes: list[list[float]] = []

    def split(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + _path_of(len(rows))])
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_to = np.flatnonzero(high > low)
        if depth < most and len(rows) > 1 and len(open_to):
            f = int(rng.choice(open_to))
            cut = float(rng.uniform(low[f], high[f]))
            left = rows[:, f] <= cut
            nodes[at][:4] = [f, cut, split(rows[left], depth + 1), split(rows[~left], depth + 1)]
        return at

    split(x, 0)
    return nodes


@dataclass(frozen=True)
class IsolationForest:
    """Trees of (feature, cut, left, right, path) nodes and the path expected of a usual row."""

    trees: list[np.ndarray]
    usual: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; rows that random splits soon set apart have the higher scores."""
        if not self.trees:
            return np.zeros(len(x))
        paths = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                f = tree[at, 0].astype(np.int64)
                inner = f >= 0
                if not inner.any():
                    break
                left = x[np.arange(len(x)), np.maximum(f, 0)] <= tree[at, 1]
                at = np.where(inner, np.where(left, tree[at, 2], tree[at, 3]), at).astype(np.int64)
            paths += tree[at, 4]
        return np.power(2.0, -paths / len(self.trees) / max(self.usual, 1e-9))


def fit_forest(stats: DataFrame, trees: int = 200, sample: int = 32, seed: int = 0) -> IsolationForest:
    """Each tree is grown in a task of its own from about ``sample`` rows of the whole table,
    chosen by a hash of their statistics and id; together about ``trees * sample`` rows.
    """
    rows = stats.count()
    share = min(1.0, trees * sample / max(rows, 1))
    columns = BASE
    place = F.xxhash64(F.lit(int(seed)), F.col("doc_id"), *columns)
    chosen = stats.where(F.pmod(place, F.lit(1 << 20)) < F.lit(share * (1 << 20))).select(
        *columns, F.pmod(F.xxhash64(place), F.lit(trees)).cast("int").alias("tree")
    )

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        ordered = pdf[columns].sort_values(columns)
        nodes = grow_tree(features(ordered), seed * 1_000_003 + tree)
        return pd.DataFrame({"tree": [tree], "rows": [len(pdf)], "nodes": [json.dumps(nodes)]})

    grown = chosen.groupBy("tree").applyInPandas(grow, "tree int, rows bigint, nodes string")
    found = sorted(grown.collect())  # one row per tree
    mean = float(np.mean([r.rows for r in found])) if found else 1.0
    return IsolationForest([np.array(json.loads(r.nodes)) for r in found], _path_of(mean))


def calibrate(scored: DataFrame, keep: float, bins: int = 10_000) -> float:
    """The least threshold that keeps the share ``keep`` of the rows labelled as good.

    Among all such thresholds this one rejects the most. Scores are counted in ``bins`` bins
    over all labelled rows, so only the counts come to the driver.
    """
    binned = scored.groupBy(F.floor(F.col("anomaly") * bins).cast("int").alias("b")).count()
    counts = sorted((r["b"], r["count"]) for r in binned.collect())
    total, kept = sum(n for _, n in counts), 0
    for b, n in counts:
        kept += n
        if kept >= keep * total:
            return (b + 1) / bins
    return 1.0


def apply_rules(
    df: DataFrame,
    labels: DataFrame | None,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    trees: int = 200,
    sample: int = 32,
    keep: float = 0.995,
    min_words: int = 10,
    most_repeated: int = 20,
    seed: int = 0,
) -> DataFrame:
    """Rows of ``df`` (or its columns ``carry``) with their rule statistics, ``base_failed``,
    ``anomaly`` and ``kept``.

    Statistics are taken of every whole text. A document fails the base rules with fewer than
    ``min_words`` words or more than ``most_repeated`` percent repeated ones. All others are
    scored by an isolation forest grown from about ``trees * sample`` of them; a score above the
    threshold rejects. The threshold keeps the share ``keep`` of the documents that ``labels``
    (doc_id, quality) mark as good and that pass the base rules; without any, nothing is rejected
    by the forest.

    Null and empty texts have no words and fail. Rows with a null id take no part in the
    calibration but are judged like others; of several labels of a document the lowest counts.
    Repeated rows are judged alike. An empty table gives an empty result. Columns named like the
    added ones are replaced. The statistics are written once to the shared folder.
    """
    stats = _stats(F.col(f"`{text}`"))
    rows = nest(df, carry, doc_id=F.col(f"`{doc_id}`"), s=stats).select(ROW, "doc_id", "s.*")
    repeated = 100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")
    failed = (F.col("n_words") < min_words) | repeated
    rows = hand_over(rows.withColumn("base_failed", failed), "quality-stats")
    judged = rows.where("not base_failed")
    forest = fit_forest(judged, trees, sample, seed)

    @F.pandas_udf("double")
    def anomaly(s: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(features(s)))

    score = anomaly(F.struct(*BASE))
    limit = 1.0
    if labels is not None:
        good = (
            labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
        )
        limit = calibrate(
            judged.join(good, "doc_id", "left_semi").select(score.alias("anomaly")), keep
        )
    rows = rows.withColumn("anomaly", score)
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))
    return unnest(rows, [*BASE, "base_failed", "anomaly", "kept"])
