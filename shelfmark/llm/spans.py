"""Words, lines and shingles of one text as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 2 * len(_powers))
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("_powers", _BASE), ("_inverses", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps)


def raw_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches where ``inside`` holds."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


def hash_runs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each stretch, the same wherever it stands.

    Prefix sums of byte times power give every stretch's polynomial by one subtraction; the
    inverse power takes the place of its start out again.
    """
    n = len(raw)
    _grow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverses[starts])


def joined(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` words in a row."""
    if len(words) < n:
        return words[:0]
    last = len(words) - n + 1
    found = words[:last].copy()
    for k in range(1, n):
        found = found * _STEP + words[k : last + k]
    return mix(found)


def word_hashes(text: str | None) -> np.ndarray:
    """Words of a text, A-Z lower-cased, in order."""
    raw = LOWER[raw_bytes(text)]
    return hash_runs(raw, *runs(~BLANK[raw]))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Distinct shingles of ``n`` words, sorted; of a shorter text its whole sequence as one."""
    words = word_hashes(text)
    return np.unique(joined(words, min(n, len(words)))) if len(words) else words
