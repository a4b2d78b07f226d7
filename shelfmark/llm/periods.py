"""Runs of repeated words in a text, found by block convolution at dyadic scales."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ROW, nest, unnest
from shelfmark.llm.spans import runs

# a prime with roots of unity of every order up to 2 ** 27; products of residues fit 64 bits
PRIME = 15 * 2**27 + 1
_P = np.uint64(PRIME)
_GENERATOR = 31
# numbers that one batch of transforms holds
BATCH = 1 << 18


@cache
def _powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * ``half``."""
    root = pow(_GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    found = np.ones(half, np.uint64)
    done = 1
    while done < half:
        step = np.uint64(pow(root, done, PRIME))
        found[done : 2 * done] = found[:done] * step % _P
        done *= 2
    return found


def _less(x: np.ndarray) -> np.ndarray:
    """``x`` below 2 * PRIME as a residue: below PRIME the difference wraps around and is larger."""
    return np.minimum(x, x - _P)


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row, a power of two long, in bit-reversed order."""
    rows, n = a.shape
    half = n // 2
    while half:
        a = a.reshape(rows, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1]
        a = np.stack([_less(u + v), (u + _P - v) * _powers(half, False) % _P], axis=2)
        half //= 2
    return a.reshape(rows, n)


def inverse(a: np.ndarray) -> np.ndarray:
    """Rows whose transform, in bit-reversed order, is ``a``."""
    rows, n = a.shape
    half = 1
    while half < n:
        a = a.reshape(rows, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1] * _powers(half, True) % _P
        a = np.stack([_less(u + v), _less(u + _P - v)], axis=2)
        half *= 2
    return a.reshape(rows, n) * np.uint64(pow(n, -1, PRIME)) % _P


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences of each block and its window at every offset, modulo PRIME.

    It is the squares of both less twice their correlation, which is one product of transforms.
    """
    b, w = blocks.shape[1], windows.shape[1]
    n = 1 << (w - 1).bit_length()
    f, g = (np.zeros((len(blocks), n), np.uint64) for _ in "fg")
    f[:, :b] = blocks[:, ::-1]
    g[:, :w] = windows
    product = inverse(transform(f) * transform(g) % _P)[:, b - 1 : w]
    squares = np.zeros((len(blocks), w + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    own = (blocks * blocks % _P).sum(axis=1, dtype=np.uint64) % _P
    return (own[:, None] + (squares[:, b:] - squares[:, : w - b + 1]) % _P + np.uint64(2) * (_P - product)) % _P


class _Found:
    """Runs so far, least period first: a stretch found again has a multiple of its period."""

    def __init__(self) -> None:
        self.period: dict[tuple[int, int], int] = {}
        self._fresh = True

    def add(self, start: int, end: int, period: int) -> None:
        if (start, end) not in self.period:
            self.period[start, end] = period
            self._fresh = False

    def explained(self, at: np.ndarray, distance: np.ndarray, block: int) -> np.ndarray:
        """Whether block and occurrence lie in one run whose period divides their distance; such a
        pair extends to that run and to no other. Of the runs that begin no later than the block
        the one that ends last is asked, which is all that long runs need.
        """
        if not self.period:
            return np.zeros(len(at), bool)
        if not self._fresh:
            self._starts, ends, periods = np.array(sorted((s, e, p) for (s, e), p in self.period.items())).T
            last = np.maximum.accumulate(ends)
            owner = np.maximum.accumulate(np.where(ends == last, np.arange(len(ends)), 0))
            self._ends, self._periods, self._fresh = ends[owner], periods[owner], True
        k = np.searchsorted(self._starts, at, "right") - 1
        inside = (k >= 0) & (at + distance + block <= self._ends[k])
        return inside & (distance % self._periods[k] == 0)


def _seeds(
    words: np.ndarray, keys: np.ndarray, order: np.ndarray, block: int, low: int, high: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Block starts and distances from ``low`` to ``high`` at which the block occurs again.

    A block is only convolved if each of its words comes again within these distances.
    """
    n = len(words)
    next_at = np.searchsorted(keys, keys + low)
    again = np.zeros(n, bool)
    again[order] = keys[np.minimum(next_at, n - 1)] <= keys + high
    again[order[next_at == n]] = False
    count = np.zeros(n + 1, np.int64)
    np.cumsum(again, out=count[1:])
    starts = np.arange(0, n - block - low + 1, block - 1)
    starts = starts[count[starts + block] - count[starts] == block]
    if not len(starts):
        return
    width = high - low + block
    beyond = np.full(max(0, starts[-1] + low + width - n), n, words.dtype)  # no word has this number
    padded = np.concatenate([words, beyond]).astype(np.uint64)
    per_batch = max(1, BATCH // (2 * width))
    for k in range(0, len(starts), per_batch):
        at = starts[k : k + per_batch]
        blocks = padded[at[:, None] + np.arange(block)]
        windows = padded[(at + low)[:, None] + np.arange(width)]
        row, offset = np.nonzero(mismatches(blocks, windows) == 0)
        start, distance = at[row], offset + low
        fits = start + distance + block <= n
        yield start[fits], distance[fits]


def _extend(words: np.ndarray, first: int, last: int, q: int, block: int, least: int, found: _Found) -> None:
    """Adds the runs of period ``q`` around the blocks from ``first`` to ``last``."""
    n, margin = len(words), 2 * block
    while True:
        lo, hi = max(0, first - margin), min(n, last + q + block + margin)
        starts, ends = runs(words[lo : hi - q] == words[lo + q : hi])
        # the stretches that the blocks stand in, and whether one goes on beyond what was compared
        own = (ends > first - lo) & (starts <= last - lo)
        starts, ends = starts[own], ends[own]
        if not len(starts):
            return
        if not (lo > 0 and starts[0] == 0) and not (hi < n and ends[-1] == hi - q - lo):
            break
        margin *= 4
    long = ends - starts + q >= max(least, 2 * q)
    for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        found.add(lo + s, lo + e + q, q)


def find_runs(words: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers below its length, in order of
    start and period.

    A run with period q holds at least max(least, 2 * q) words, so from its start max(least - q, q)
    and more words come again at distance q. Blocks of b words at every (b - 1)-th place thus have one that
    lies inside them whole, for b from about least / 4 and q up to 4 * b - 3; twice the block serves
    the next distances. Zero mismatches give block and distance, neighbouring blocks of one distance
    are one seed, and comparing the words around a seed gives the run, or nothing where the
    convolution was only zero modulo the prime.
    """
    n = len(words)
    if least < 4:
        raise ValueError("runs of less than 4 words are not looked for")
    if n < least:
        return []
    order = np.argsort(words, kind="stable")
    keys = words[order].astype(np.int64) * (3 * n + 8) + order
    found = _Found()
    block, low = 2, 1
    while 4 * block - 2 <= -(-least // 2):
        block *= 2
    while low <= n // 2:
        high = min(4 * block - 3, n // 2)
        at, distance = [], []
        for i, q in _seeds(words, keys, order, block, low, high):
            new = ~found.explained(i, q, block)
            at.append(i[new])
            distance.append(q[new])
        if at:
            i, q = np.concatenate(at), np.concatenate(distance)
            by = np.lexsort((i, q))
            i, q = i[by], q[by]
            for part in np.split(np.arange(len(q)), np.flatnonzero(np.diff(q)) + 1):
                if not len(part):
                    continue
                d = int(q[part[0]])
                own = i[part][~found.explained(i[part], q[part], block)]
                for chain in np.split(own, np.flatnonzero(np.diff(own) != block - 1) + 1):
                    if len(chain):
                        _extend(words, int(chain[0]), int(chain[-1]), d, block, least, found)
        low, block = 4 * block - 2, 2 * block
    return sorted(((s, e - s, p) for (s, e), p in found.period.items()), key=lambda r: (r[0], r[2]))


def split_words(text: str | None) -> list[bytes]:
    """Words between blanks; ``bytes.split`` parts at just these six characters."""
    return (text or "").encode("utf-8", "replace").split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers in order of their first occurrence."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def collapse(text: str | None, least: int = 12) -> tuple[list[tuple[int, int, int]], str]:
    """Runs of a text, and its words without those that only repeat a run's first period."""
    words = split_words(text)
    found = find_runs(numbered(words), least)
    if found:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return found, b" ".join(words).decode("utf-8")


def collapse_runs(
    df: DataFrame, text: str = "text", carry: Sequence[str] | None = None, least: int = 12
) -> DataFrame:
    """Rows of ``df`` (or its columns ``carry``) with ``runs``, the periodic runs of the whole text as
    (start, length, period) in order of start and period, and ``collapsed``, the text's words without
    the repeats, joined by one blank.

    A run is a stretch of words that its smallest period repeats, of at least ``least`` words and two
    periods, and that no neighbouring word extends. A word goes if any run has it
    after that run's first period. Words lie between ASCII blanks. A null or blank text has no runs
    and no words; repeated rows are judged alike, an empty table gives an empty result, columns
    named like the added ones are replaced. One text is handled in one task, in memory that
    grows with its words; the time for a text of n words grows with n log n and its repeats.
    """

    @F.pandas_udf("struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        pairs = [collapse(t, least) for t in texts]
        return pd.DataFrame(
            {
                "runs": [[{"start": s, "length": n, "period": p} for s, n, p in found] for found, _ in pairs],
                "collapsed": [kept for _, kept in pairs],
            }
        )

    rows = nest(df, carry, j=judged(F.col(f"`{text}`")))
    return unnest(rows.select(ROW, "j.*"), ["runs", "collapsed"])
