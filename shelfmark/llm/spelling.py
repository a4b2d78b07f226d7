"""Grouping of spelling variants: words one edit apart, found by dense prefix-suffix tiling."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import lower_ascii
from shelfmark.session import hand_over

LETTERS = r"A-Za-zÀ-ÿ"
# words of one side of a tile, and their code points
BLOCK = 1_000
BLOCK_POINTS = 4_000_000
# rows of small groups that one task compares, group by group
PACK = 4_000


def letter_runs(df: DataFrame, text: str = "text", letters: str = LETTERS, least: int = 1) -> DataFrame:
    """Rows of ``df`` without ``text``, one for every maximal run of letters of at least ``least``
    code points in the whole text, A-Z lower-cased, as ``word``. A null text has none.
    """
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{letters}]{{{int(least)},}}"), F.lit(0))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (text.lower(), "word")]
    return df.select(*kept, F.explode(found).alias("word")).withColumn("word", lower_ascii(F.col("word")))


def without(word: Column, at: Column) -> Column:
    """``word`` without its code point number ``at``, from 0."""
    at = at.cast("int")
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def padded(words: list[str], width: int, right: bool = False) -> np.ndarray:
    """Code points of words of at most ``width``, one row each, filled up with 0."""
    filled = "".join([w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words])
    points = np.frombuffer(filled.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, width)
    return points.astype(np.uint8) if points.size and points.max() < 256 else points


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of ``a`` and each of ``b`` the number of leading columns that agree."""
    width = a.shape[1]
    alive = np.ones((len(a), len(b)), bool)
    count = np.zeros((len(a), len(b)), np.min_scalar_type(2 * width + 1))
    for c in range(width):
        alive &= a[:, c, None] == b[None, :, c]
        if not alive.any():
            break
        count += alive
    return count


def one_edit(a: list[str], b: list[str], band: int, known: int = -1) -> np.ndarray:
    """Which words of ``a`` and ``b``, all of ``band`` or ``band`` + 1 code points, are one edit
    apart; pairs of two longer ones are left to the next band. Pairs that have ``known`` first
    code points in common are left out too, if it isn't negative.
    """
    width = band + 1
    n, m = (np.array([len(w) for w in x]) for x in (a, b))
    prefix = _common(padded(a, width), padded(b, width))
    suffix = _common(padded(a, width, True)[:, ::-1], padded(b, width, True)[:, ::-1])
    longer = np.maximum(n[:, None], m[None, :])
    near = (prefix + suffix + 1 >= longer) & (np.minimum(n[:, None], m[None, :]) == band)
    if known >= 0:
        near &= prefix < known
    return near


def _partial(first: pd.DataFrame, second: pd.DataFrame, band: int, side: str) -> list[tuple]:
    """(word, n_near, best_n, best) of the words of two blocks; both may be the same block."""
    same = first is second
    a, b = first["word"].tolist(), second["word"].tolist()
    near = one_edit(a, b, band, band // 2 if side == "s" else -1)
    if same:
        np.fill_diagonal(near, False)
    rows = []
    sides = [(first, second, near)] if same else [(first, second, near), (second, first, near.T)]
    for own, other, hit in sides:
        counts = hit.sum(axis=1)
        words, names, ns = own["word"].to_numpy(), other["word"].to_numpy(), other["n"].to_numpy()
        for i in np.flatnonzero(counts):
            best = hit[i].argmax()  # blocks are in order of falling n, then word
            rows.append((words[i], int(counts[i]), int(ns[best]), names[best]))
    return rows


def _tiled(pdf: pd.DataFrame) -> pd.DataFrame:
    """Compares the words of every group of a task: all of a small group, or two blocks."""
    pdf = pdf.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    rows: list[tuple] = []
    for (band, side, _), group in pdf.groupby(["band", "side", "key"], sort=False):
        one, two = group["first"].iloc[0], group["second"].iloc[0]
        a = group if one == two else group[group["own"] == one]
        b = a if one == two else group[group["own"] == two]
        if len(a) and len(b):
            rows += _partial(a, b, int(band), side)
    return pd.DataFrame(rows, columns=["word", "n_near", "best_n", "best"])


def _tiles(words: DataFrame) -> DataFrame:
    """Rows of the tiles a word belongs to: (pack, name) says which task compares them.

    Words of m and m + 1 code points share their first or their last m // 2 if they are one
    edit apart, as the edit cannot lie in both halves. So a word meets only words of the same half,
    in the bands of its own length and of one less. Groups are cut in blocks by a hash of the word
    and every two blocks are a tile; small groups are dealt to packs.
    """
    size = F.length("word")
    halves = [
        F.struct(
            band.alias("band"),
            F.lit(side).alias("side"),
            (F.substring("word", F.lit(1), half) if side == "p" else F.substring("word", size - half + 1, half)).alias("key"),
        )
        for band in (size, size - 1)
        for half in [F.floor(band / 2).cast("int")]
        for side in "ps"
    ]
    group = ["band", "side", "key"]
    keyed = words.select("word", "n", F.explode(F.array(*halves)).alias("h")).select("word", "n", "h.*").where("band >= 0")
    blocks = (
        keyed.groupBy(*group)
        .agg(F.count("*").alias("rows"), F.sum((F.length("word") == F.col("band")).cast("int")).alias("short"))
        .where("rows > 1 and short > 0")
        .withColumn("blocks", F.ceil(F.greatest(F.col("rows") / BLOCK, F.col("rows") * (F.col("band") + 1) / BLOCK_POINTS)).cast("int"))
    )
    blocks = hand_over(blocks, "word-groups")
    total = blocks.where("blocks = 1").agg(F.sum("rows")).first()[0] or 0
    small = F.col("blocks") == 1
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = (
        keyed.join(blocks.select(*group, "blocks"), group)
        .withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn("other", other)
    )
    packs = max(1, math.ceil(total / PACK))
    return placed.select(
        *group,
        "word",
        "n",
        "own",
        F.least("own", "other").alias("first"),
        F.greatest("own", "other").alias("second"),
        F.when(small, F.pmod(F.xxhash64(*group), F.lit(packs))).otherwise(-1).alias("pack"),
        F.when(small, "").otherwise(F.concat_ws(":", "side", "band", "key")).alias("name"),
    )


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n).

    Two words are near if one inserted, deleted or replaced code point makes one the other. A word's
    form is its near word of largest ``n``, of several the first in code-point order, if that has at
    least ``ratio`` (more than 1) times the word's own ``n``; else null. Following forms to the
    last gives the root; a word without a form is its own root. ``n_near`` counts near words.

    Every pair of near words is met in one tile: dense matrices of code points, of which common
    prefix and common suffix together reach the longer length less one. A task returns one
    row per word and tile, so nothing grows with the number of near pairs but the comparing.

    Words repeated in ``words`` are added up, null words go, a null ``n`` counts as 0. An empty
    table gives an empty result; words of any length and the empty word are words.
    """
    if ratio <= 1:
        raise ValueError("ratio must be more than 1")
    counted = words.where("word is not null").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    known = hand_over(counted, "words")
    found = (
        _tiles(known)
        .groupBy("pack", "name", "first", "second")
        .applyInPandas(_tiled, "word string, n_near bigint, best_n bigint, best string")
    )
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    )
    joined = known.join(best, "word", "left")
    has_form = -F.col("b.n") >= ratio * F.col("n")
    judged = hand_over(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("b.best")).alias("form"),
            F.when(has_form, -F.col("b.n")).alias("form_n"),
        ),
        "forms",
    )
    return _with_roots(judged, ratio)


def _with_roots(judged: DataFrame, ratio: int) -> DataFrame:
    """Doubles the known part of every way to its root: counts grow by ``ratio`` at each step, so the
    rounds grow with the logarithm of the logarithm of the largest count. A count of 0 may
    have one step more.
    """
    most = judged.agg(F.max("form_n")).first()[0]
    steps = 0 if most is None else 2 + int(math.log(max(1, most)) / math.log(ratio))
    way = judged.where("form is not null").select("word", F.col("form").alias("root"))
    reached = 1
    while reached < steps:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        way = way.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        way = hand_over(way, "roots")
        reached *= 2
    return judged.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
