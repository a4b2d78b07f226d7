"""Spelling variants, periodic runs and top products against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import periods, spelling, top_products


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_variants(counts, ratio=10):
    form = {}
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    found = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None and n:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return found


def test_lengths_of_common_parts():
    words = ["", "a", "ab", "abc", "acb", "aab", "aaab", "ba", "xabc", "axbc", "abcx"]
    for m in range(5):
        band = [w for w in words if len(w) in (m, m + 1)]
        got = spelling.one_edit(band, band, m)
        for i, a in enumerate(band):
            for j, b in enumerate(band):
                want = one_edit(a, b) and min(len(a), len(b)) == m
                assert i == j or got[i, j] == want, (a, b)


@pytest.mark.parametrize("block, pack", [(1000, 4000), (7, 20)])
def test_variants(spark, monkeypatch, block, pack):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "PACK", pack)
    rng = random.Random(block)
    base = ["".join(rng.choice("abé𝒳ÿ") for _ in range(rng.randrange(0, 9))) for _ in range(25)]
    counts = {}
    for w in base:
        for step in range(12):
            counts.setdefault(w, int(10 ** (4 * rng.random() ** 2)))
            k = rng.randrange(len(w) + 1)
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "b" + w[k:], w[:k] + "é" + w[k + 1 :]])
    # one hot prefix
    for k in range(60):
        counts.setdefault("prefix" + chr(97 + k % 26) * (1 + k % 2) + chr(97 + k // 26), 1 + 37**k % 101)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = spelling.group_variants(df)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(counts) and set(got) == brute_variants(counts)


def test_chains_of_forms_end_at_the_root(spark):
    chain = {"a" * (5 + k): 10**k for k in range(9)}
    got = {r.word: r.root for r in spelling.group_variants(spark.createDataFrame(list(chain.items()), "word string, n bigint")).collect()}
    assert set(got.values()) == {"a" * 13} and len(got) == 9


def test_odd_words(spark):
    rows = [("abc", 5), ("abc", 6), (None, 7), ("abd", None), ("", 1), ("q" * 5000, 3), ("q" * 5001, 30)]
    got = {r.word: r for r in spelling.group_variants(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert set(got) == {"abc", "abd", "", "q" * 5000, "q" * 5001}
    assert got["abc"].n == 11 and got["abd"].form == "abc" and got["q" * 5000].form == "q" * 5001
    empty = spelling.group_variants(spark.createDataFrame([], "word string, n bigint"))
    assert empty.count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(empty, ratio=1)


def test_runs_of_letters(spark):
    rows = [(1, "Ab×cÿ 12 ÀB-x", "clash"), (2, None, None), (3, "", "z"), (None, "a" * 100_000, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, word string")
    got = [(r.doc_id, r.word) for r in spelling.letter_runs(df).collect()]
    assert sorted(got, key=repr) == sorted([(1, "ab×cÿ"), (1, "Àb"), (1, "x"), (None, "a" * 100_000)], key=repr)
    cut = spark.createDataFrame([("abcd", 0), ("abcd", 3), ("é𝒳z", 1)], "w string, k int")
    assert [r[0] for r in cut.select(spelling.without(F.col("w"), F.col("k"))).collect()] == ["bcd", "abc", "éz"]


def brute_runs(w, least):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=20), st.integers(1, 7)), max_size=6),
    st.sampled_from([4, 5, 9, 12, 12, 25]),
)
def test_runs(parts, least):
    words = [x for part, times in parts for x in part * times][:250]
    numbers = periods.numbered([b"%d" % x for x in words])
    assert periods.find_runs(numbers, least) == brute_runs(words, least)


def test_transform_is_exact():
    rng = np.random.default_rng(3)
    for b, w in ((2, 5), (4, 16), (8, 23), (64, 191)):
        blocks = rng.integers(0, 2**31 - 1, (3, b)).astype(np.uint64) % np.uint64(periods.PRIME)
        windows = rng.integers(0, 2**31 - 1, (3, w)).astype(np.uint64) % np.uint64(periods.PRIME)
        got = periods.mismatches(blocks, windows)
        for r in range(3):
            f, g = ([int(x) for x in m[r]] for m in (blocks, windows))
            want = [sum((f[k] - g[t + k]) ** 2 for k in range(b)) % periods.PRIME for t in range(w - b + 1)]
            assert got[r].tolist() == want
        assert (periods.inverse(periods.transform(windows[:, :4])) == windows[:, :4]).all()


def test_a_false_zero_of_the_transform_gives_no_run(monkeypatch):
    monkeypatch.setattr(periods, "mismatches", lambda b, w: np.zeros((len(b), w.shape[1] - b.shape[1] + 1), np.uint64))
    rng = random.Random(5)
    for _ in range(30):
        words = [x for _ in range(4) for x in [rng.randrange(3) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 5)]
        numbers = periods.numbered([b"%d" % x for x in words])
        assert periods.find_runs(numbers) == brute_runs(words, 12)


def test_collapsed_texts(spark):
    line = "a b c d e f g"
    long = "x " * 200_000 + "y"
    rows = [
        (1, f"{line}\n{line}\t{line} h", "clash", None),
        (2, None, "z", None),
        (3, " \n ", None, None),
        (None, line, "z", None),
        (4, long, "z", None),
        (4, long, "z", None),
        (5, "ab c " * 12 + "ab", "z", None),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, Collapsed int")
    found = periods.collapse_runs(df)
    assert found.columns == ["doc_id", "text", "runs", "collapsed"]
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()]
    assert got == [
        (1, [(0, 21, 7)], f"{line} h"),
        (2, [], ""),
        (3, [], ""),
        (None, [], line),
        (4, [(0, 200_000, 1)], "x y"),
        (4, [(0, 200_000, 1)], "x y"),
        (5, [(0, 12, 1)], "ab c ab"),
    ]
    assert periods.collapse_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(5, np.int64), 3)


LONG = 2**63


def brute_products(rows, k, every):
    """rows: (id, vector); of each row its query, then its best."""
    valid = [(i, v) for i, v in rows if v is not None and None not in v]
    found = []
    for a, (i, v) in enumerate(valid):
        if i is None or i % every:
            continue
        scored = []
        for b, (j, w) in enumerate(valid):
            if a != b:
                s = sum(x * y for x, y in zip(v, w, strict=False))
                scored.append((-max(-LONG, min(LONG - 1, s)), j is None, j or 0))
        found += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(sorted(scored)[:k])]
    return sorted(found, key=repr)


def products(spark, rows, every=5, k=3):
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    found = top_products.top_products(df, F.col("vec_id") % every == 0, k=k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("kind", ["spread", "near", "ties", "short"])
def test_products(spark, monkeypatch, kind):
    monkeypatch.setattr(top_products, "BUCKET", 16)
    monkeypatch.setattr(top_products, "QUERIES", 10)
    rng = np.random.default_rng(7)
    n = 200
    if kind == "spread":  # lengths differ, so whole buckets go
        m = rng.normal(0, 30, (n, 6)) * rng.exponential(1.5, (n, 1)) ** 2
    elif kind == "near":  # close together, so coordinates decide
        m = rng.normal(0, 100, (10, 6))[np.arange(n) % 10] + rng.normal(0, 4, (n, 6))
    elif kind == "ties":
        m = rng.integers(-1, 2, (n, 3))
    else:
        m = rng.integers(-9, 1, (7, 2))
    rows = [(int(i), [int(x) for x in v]) for i, v in enumerate(m)]
    assert products(spark, rows) == brute_products(rows, 3, 5)


def test_buckets_are_pruned():
    """What pruning leaves has the answer; coordinates rule out most vectors of a narrow bucket."""
    rng = np.random.default_rng(1)
    m = rng.normal(0, 1, (3000, 16))
    units = m / np.linalg.norm(m, axis=1)[:, None]
    unit = units[0]
    left = top_products.coordinate_candidates(unit, units, 0.9)
    assert set(np.flatnonzero(units @ unit >= 0.9)) <= set(left) and len(left) < 1500
    table = lambda rows, vectors, least: pa.table(
        {"row": rows, "id": rows, "v": pa.array(vectors, pa.list_(pa.int64())), "norm": [float(np.linalg.norm(v)) for v in vectors], "least": pa.array(least, pa.int64())}
    )
    asked = table([9], [[3, 4]], [26])
    bucket = table([1, 2, 3], [[3, 4], [4, 3], [0, 1]], [None] * 3)
    assert top_products.search_bucket(asked, bucket, 5) == []
    assert top_products.search_bucket(table([9], [[3, 4]], [25]), bucket, 5) == [(0, 0, 25)]
    assert top_products.search_bucket(table([9], [[3, 4]], [None]), bucket, 2) == [(0, 0, 25), (0, 1, 24)]


def test_odd_vectors(spark):
    rows = [
        (0, [1, 2]), (0, [1, 2]), (None, [1, 2]), (None, [5]), (5, []), (10, [0, 0, 0]), (15, None), (20, [1, None]),
        (25, [2**40, -(2**41)]), (26, [2**40, 3]), (-5, [-1, 0]), (7, [2**62, 2**62]),
    ]
    assert products(spark, rows) == brute_products(rows, 3, 5)
    assert products(spark, rows[:1]) == [] and products(spark, []) == []
    hot = [(5 if k % 3 else k, [3, -1]) for k in range(60)]
    assert products(spark, hot) == brute_products(hot, 3, 5)
