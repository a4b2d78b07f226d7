"""Jaccard join, decontamination and line dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, dedup_lines, jaccard_join
from shelfmark.llm.components import components
from shelfmark.llm.queries import SQL

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingles(text, n):
    w = words(text)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute_components(rows, n, percent):
    """rows: (id, text) with different ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, base, copies, most):
    """Copies of a text with up to ``most`` words replaced, dropped or added."""
    found = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(most + 1)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[f"n{rng.randrange(10**6)}"], [], [w[at], "plus"]])
        found.append(" ".join(w))
    return found


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_components_of_near_copies(spark, n, percent):
    rng = random.Random(n)
    texts = []
    for length in (3, 5, 8, 12, 30, 60, 150, 400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        texts += family(rng, base, 40, max(1, length // 6))
    texts += texts[:20] + ["", " ", None, "Ab c", "aB C"]
    rows = list(enumerate(texts, 100))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = jaccard_join.linked_components(df, words=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, n, percent)
    assert len(found) == len(rows)


def test_jaccard_join_of_odd_rows(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (1, "x y z u v w"), (2, "x y z u v w"), (2, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("component_id", F.lit(9))
    found = sorted(jaccard_join.linked_components(df).collect(), key=repr)
    assert [tuple(r) for r in found] == sorted(
        [(None, 2, None)] * 2 + [(1, 3, 1), (2, 3, 1), (2, 2, 1), (3, 2, 1), (3, 2, 1), (4, 0, 4), (5, 0, 5)],
        key=lambda r: f"Row(doc_id={r[0]}, n_shingles={r[1]}, component_id={r[2]})",
    )
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_join.linked_components(empty).count() == 0


def test_links_are_counted(spark, monkeypatch):
    """Chains, triangles, copies and several blocks of a cluster; every pair counts once."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rng = random.Random(5)
    texts = []
    for length in (8, 40, 120):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        texts += family(rng, base, 40, max(1, length // 12))
    rows = list(enumerate(texts + texts[:15] + ["", None, "a b c d e"]))
    df = spark.createDataFrame([*rows, (None, texts[0]), rows[3]], "doc_id bigint, text string").repartition(3)
    found = jaccard_join.linked_documents(df).collect()
    sets = [shingles(t, 4) for _, t in rows]
    want = {
        i: sum(1 for j, b in enumerate(sets) if i != j and a & b and 100 * len(a & b) >= 85 * len(a | b))
        for i, a in enumerate(sets)
    }
    want[None] = None
    assert {r.doc_id: r.n_links for r in found} == want and len(found) == len(rows) + 2
    assert max(want[i] for i, _ in rows) > 10


def test_one_id_heads_two_groups_of_copies(spark):
    a, b = "a b c d e", "x y z u v w"
    rows = [(2, a), (2, b), (5, a), (6, b)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = jaccard_join.linked_components(df).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(2, 2), (2, 2), (5, 2), (6, 2)]


@settings(deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**9), st.sampled_from([85, 80, 75]))
def test_near_sets_share_a_signature(size, seed, percent):
    rng = np.random.default_rng(seed)
    scheme = jaccard_join.Scheme(percent)
    a = rng.integers(0, 2**64, size, np.uint64)
    gone = rng.integers(0, max(1, size // 4) + 1)
    new = rng.integers(0, 2**64, rng.integers(0, max(1, size // 8) + 1), np.uint64)
    b = np.union1d(a[gone:], new)
    a = np.unique(a)
    same = len(np.intersect1d(a, b))
    if same and 100 * same >= percent * (len(a) + len(b) - same):
        assert set(scheme.signatures(a).tolist()) & set(scheme.signatures(b).tolist())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 130)] + [(129, 200), (7, 7)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.v: r.component for r in found} == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys([*range(100, 130), 200], 100)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_leaks(docs, items, k=5, threshold=0.8):
    """The best of all windows, aligned or not."""
    found = {}
    for item, text in items:
        w = words(text)
        n = min(k, len(w))
        if not w:
            continue
        want = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        for doc, body in docs:
            d = words(body)
            for start in range(max(1, len(d) - len(w) + 1)):
                cut = d[start : start + len(w)]
                got = Counter(tuple(cut[i : i + n]) for i in range(len(cut) - n + 1))
                both = sum((got & want).values())
                value = both / (sum(got.values()) + sum(want.values()) - both)
                if value >= threshold:
                    key = (doc, item)
                    value, start = max(found.get(key, (0, 0)), (value, -start))
                    found[key] = value, start
    return {key: (value, -start) for key, (value, start) in found.items()}


def test_leaks_equal_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=length))) for k, length in enumerate([1, 3, 5, 14, 20, 33, 33, 59, 120, 300])]
    items += [(20, None), (21, " "), (22, items[4][1]), (4, items[4][1])]
    docs = []
    for _ in range(60):
        body = rng.choices([f"v{k}" for k in range(3000)], k=rng.randrange(5, 300))
        passage = list(words(rng.choice(items[3:10])[1]))
        for _ in range(rng.randrange(4)):
            passage[rng.randrange(len(passage))] = "changed"
        at = rng.randrange(len(body))
        docs.append((len(docs), " ".join(body[:at] + [p.upper() for p in passage] + body[at:])))
    docs += [(None, None), (900, ""), (901, items[3][1]), (901, items[3][1]), (902, " ".join(items[5][1].split()[:-2]))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("w", F.lit(1))
    found = decontaminate.leaks(df, bench).collect()
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found}
    assert len(got) == len(found)
    want = brute_leaks(docs, items)
    assert set(got) == set(want)
    for key, (value, start) in want.items():
        assert got[key][0] == pytest.approx(value) and got[key][1] == start


def test_leaks_of_moved_passages(spark):
    """Best windows that start where no shared shingle aligns them: new words, swapped halves."""
    rng = random.Random(4)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(120))) for k in range(4)]
    docs = []
    for k, text in items:
        w = words(text)
        before, after, new = ([f"{c}{rng.random()}" for _ in range(n)] for c, n in (("b", 50), ("a", 60), ("n", 8)))
        docs.append((k, " ".join(before + w[4:60] + new + w[60:-4] + after)))
        docs.append((10 + k, " ".join(before + w[60:] + w[:60] + after)))
        docs.append((20 + k, " ".join(before + w[:40] + after)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = decontaminate.leaks(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = brute_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in found} == set(want) and len(want) == len(found) == 8
    for r in found:
        assert (r.similarity, r.start) == pytest.approx(want[r.doc_id, r.item_id])
    # and the SQL of the query finds them too
    con = duckdb.connect()
    for name, rows in (("documents", docs), ("benchmark", items)):
        key = "doc_id" if name == "documents" else "item_id"
        con.register(name, pa.table({key: [i for i, _ in rows], "text": [t for _, t in rows]}))
    told = con.execute(SQL["op1_decontaminate"]).fetchall()
    assert {(d, i): (v, s) for d, i, s, _, v in told} == {k: (pytest.approx(v), s) for k, (v, s) in want.items()}


def test_few_unrelated_pairs_are_proposed(spark):
    """The index leaves out most pairs of a length that have nothing in common."""
    rng = random.Random(9)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(300)]
    items = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts[:100])], "item_id bigint, text string")
    items = decontaminate.index_items(items, 5).withColumn("item_no", F.col("item_id"))
    windows = spark.createDataFrame([(k, 60, t) for k, t in enumerate(texts[50:])], "window bigint, length int, words array<string>")
    windows = decontaminate.fingerprints(windows, "words", "prints")
    pairs = {(r.window, r.item_no) for r in decontaminate.proposed(windows, items).select("window", "item_no").distinct().collect()}
    assert len(pairs) < 0.2 * 250 * 100
    assert {(k, k + 50) for k in range(50)} <= pairs
    near = {(r.window, r.item_no) for r in decontaminate.near_pairs(windows, items).collect()}
    assert {(k, k + 50) for k in range(50)} <= near and len(near) < 60


def test_leaks_at_the_threshold(spark):
    """Many windows at a similarity just over 0.8, with the last words replaced: none is lost."""
    items, docs = [], []
    for k in range(300):
        w = [f"i{k}x{j}" for j in range(94)]
        items.append((k, " ".join(w)))
        docs.append((k, " ".join(w[:84] + [f"n{k}x{j}" for j in range(10)])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = decontaminate.leaks(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(k, k) for k in range(300)]
    assert all(r.similarity == pytest.approx(80 / 100) for r in found)


def test_leaks_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id bigint, text string")
    assert decontaminate.leaks(empty, bench).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id bigint, text string")
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.leaks(docs, bench).count() == 1


def test_blocks_find_all_within_the_radius():
    rng = random.Random(2)
    for _ in range(2000):
        value, away = rng.getrandbits(64), rng.randrange(decontaminate.RADIUS + 1)
        other = value
        for bit in rng.sample(range(64), away):
            other ^= 1 << bit
        width = decontaminate.WIDTH
        parts = [((value ^ other) >> (width * i)) & ((1 << width) - 1) for i in range(64 // width)]
        assert min(bin(p).count("1") for p in parts) <= decontaminate.WINDOW_BITS + decontaminate.ITEM_BITS


def brute_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)

    def largest(ids):
        return max((i for i in ids if i is not None), default=None)

    found = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or largest(holders[key(x)]) == i]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        found.append((i, len(lines), len(lines) - len(kept), digest))
    return sorted(found, key=repr)


def test_common_lines_equal_brute_force(spark):
    rng = random.Random(3)
    pool = [f"line {k} " + "äx" * rng.randrange(14, 30) for k in range(60)]
    rows = []
    for i in range(80):
        lines = [rng.choice([str.upper, str.lower, str.strip, "  {}\t".format])(rng.choice(pool)) for _ in range(rng.randrange(1, 12))]
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, pool[0]), (None, pool[1]), (5, rows[5][1]), (6, pool[0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_lines", F.lit("x"))
    found = dedup_lines.drop_common_lines(df).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)
    )
    assert sorted(map(tuple, found.collect()), key=repr) == brute_lines(rows)
    for settings_ in ({"batches": 1}, {"batches": 9, "fanout": 2}, {"batch_docs": 13}):
        again = dedup_lines.drop_common_lines(df, **settings_)
        again = again.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
        assert sorted(map(tuple, again.collect()), key=repr) == brute_lines(rows)
    assert dedup_lines.drop_common_lines(df.limit(0)).count() == 0


def test_ranges_of_ids_hold_every_row_once(spark):
    ids = [None, None, *range(50), *[7] * 40, -(1 << 63), (1 << 63) - 1, (1 << 63) - 2]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    for n in (1, 2, 5, 200):
        ranges = dedup_lines.id_ranges(rows, n)
        parts = [[r.doc_id for r in rows.where(x).collect()] for x in ranges]
        assert len(ranges) <= n and sorted(map(repr, sum(parts, []))) == sorted(map(repr, ids))
        assert None not in sum(parts[:-1], [])
        for above, below in zip(parts, parts[1:]):
            assert min(above, default=1 << 63) > max((i for i in below if i is not None), default=-(1 << 63) - 1)


def test_batches_lose_what_the_runs_hold(spark, monkeypatch):
    """Lines that a run holds often enough are lost as a batch comes, and not counted again."""
    line, rare = "a line that very many documents hold, word by word", "another line that only one document holds, {}"
    rows = [(i, f"{line}\n{rare.format(i)}\nshort") for i in range(80)]
    added, add = [], dedup_lines.LineRuns.add

    def watched(self, lines):
        added.append(lines.where("h1 is not null").count())
        add(self, lines)

    monkeypatch.setattr(dedup_lines.LineRuns, "add", watched)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = dedup_lines.drop_common_lines(df, batches=4).collect()
    assert {(r.doc_id, r.n_dropped) for r in found} == {(i, int(i < 79)) for i in range(80)}
    # the first batch holds both lines of its documents, the others only the rare one
    assert len(added) == 4 and added[0] > 30 and sum(added) - added[0] == 80 - added[0] // 2


def test_new_batches_lose_lines_of_earlier_ones(spark):
    """Every batch is anti-joined with the runs and adds its own; levels stay short."""
    runs = dedup_lines.LineRuns(spark, fanout=3)
    seen = set()
    for batch in range(8):
        rows = [(batch * 10 + d, (batch * 5 + 3 * d + k) % 31, 0) for d in range(4) for k in range(5)]
        lines = spark.createDataFrame(rows, "doc_id bigint, h1 bigint, h2 bigint")
        left = {r.h1 for r in runs.anti_join(lines).collect()}
        assert left == {r[1] for r in rows} - seen
        runs.add(lines)
        seen |= {r[1] for r in rows}
        assert all(len(level) < 3 for level in runs.levels)
    assert {r.h1 for r in runs.keys().collect()} == seen
