"""Mixing, sharding and chat formatting: brute force, laws and exact round trips."""

import hashlib
import time
import math
import struct
import zlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import chat, mixing, sharding
from shelfmark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, source string, size bigint"


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """sizes: by source. Cuts the sources above their room one round after the other."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_to, left = {}, set(names), share * sum(sizes.values())
    while open_to:
        unit = left / sum(w[s] for s in open_to)
        above = {s for s in open_to if unit * w[s] > most * sizes[s]}
        if not above:
            return target | {s: unit * w[s] for s in open_to}
        target |= {s: most * sizes[s] for s in above}
        left -= sum(target[s] for s in above)
        open_to -= above
    return target


@pytest.mark.parametrize("sizes", [[5, 5, 5], [100, 1, 1, 1, 50], [1], [0, 0], [7, 0, 900, 3, 3, 2, 40]])
def test_targets_equal_brute_force(spark, sizes):
    by_source = {f"s{k}" if k else None: n for k, n in enumerate(sizes)}
    rows = [(k, s, n) for k, (s, n) in enumerate(by_source.items())]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA), size=F.col("size")).collect()
    want = brute_targets(by_source)
    assert {r.source: r.target for r in found} == pytest.approx(want)


def test_words_taken_come_near_the_targets(spark):
    for name in ("sf0.01", "sf0.001"):
        rows = QUERIES["op5_mix_sources"](spark, f"/root/testdata/{name}").collect()
        docs = spark.read.parquet(f"/root/testdata/{name}/documents.parquet").collect()
        source = {r.doc_id: r.source for r in docs}
        taken, target, largest = defaultdict(int), {}, defaultdict(int)
        for r in rows:
            s = source[r.doc_id]
            assert r.taken <= 2 * r.size
            taken[s] += r.taken
            target[s] = r.target
            largest[s] = max(largest[s], r.size)
        assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in target)


def test_mix_of_odd_rows_and_emission(spark):
    rows = [(1, "a", None), (1, "a", None), (None, None, 4), (2, "b", 0), (3, "b", 9), (3, "b", 9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"copies": F.lit("x"), "rn": F.lit(1), "u": F.lit(2)})
    mixed = mixing.mix(df, size=F.col("size"))
    assert mixed.count() == len(rows)
    out = mixing.emit(mixed, ["doc_id", "source", "rn", "u"])
    assert out.count() == mixed.agg(F.sum("copies")).first()[0] and out.columns == ["doc_id", "source", "rn", "u"]
    assert mixing.mix(df.limit(0), size=F.col("size")).count() == 0
    again = mixing.mix(df.repartition(3), size=F.col("size"))
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, again.collect()))


def brute_place(number, rows, seed=0):
    """Feistel rounds on (quotient, remainder), walked until the number is a row's."""
    a = math.isqrt(rows - 1) + 1
    b = -(-rows // a)
    while True:
        left, right = divmod(number, b)
        for k in range(sharding.ROUNDS):
            half = right if k % 2 == 0 else left
            h = 42
            for value, code in ((seed, "<q"), (k, "<i"), (half, "<q")):
                h = xxhash.xxh64_intdigest(struct.pack(code, value), seed=h)
            h -= (h >> 63) << 64
            if k % 2 == 0:
                left = (left + h % a) % a
            else:
                right = (right + h % b) % b
        number = left * b + right
        if number < rows:
            return number


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 10, 97, 1000])
def test_shards_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(k * 3, f"text {k}") for k in range(rows)], "doc_id bigint, text string")
    found = sharding.shard(df.repartition(3), 8).collect()
    got = {r.doc_id: (r.shard, r.slot) for r in found}
    places = {k * 3: brute_place(k, rows) if rows > 1 else 0 for k in range(rows)}
    assert got == {i: (p % 8, p // 8) for i, p in places.items()}


def test_shards_are_even_and_gapless(spark):
    found = QUERIES["op7_shard"](spark, FOLDER).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert all((r.size, r.text_crc32) == (len(text[r.doc_id]) + 16, zlib.crc32(text[r.doc_id])) for r in found)


def test_shards_of_odd_rows(spark):
    rows = [(None, None), (None, "x"), (1, ""), (1, ""), (2, "é" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"shard": F.lit("x"), "p": F.lit(1), "_l": F.lit(2)})
    found = sharding.shard(df, 3)
    assert found.count() == 5 and sorted(r.shard for r in found.collect()) == [0, 0, 1, 1, 2]
    assert found.columns == ["doc_id", "text", "p", "_l", "size", "text_crc32", "shard", "slot"]
    assert sharding.shard(df.limit(0), 3).count() == 0


TRICKY = [
    "", "plain", "[INST]", "</s>", "[+]", "[:]", "\\", "\\[", "[\\", "<\\/s>", "[\\INST]", "a\\\\b<[",
    "[/INST][OUT]x</s>", "line\nline\r\n", "[ROLE]x[:]y[/ROLE]", "é😀[", "</s>[INST] ok [/INST]",
]
ROLES = ["user", "assistant", "assistant", "system", "tool[:]", "", "user", "user", "assistant"]


def test_conversations_come_back_exactly(spark):
    rows = []
    for conv in range(40):
        for turn in range(conv % 11 + 1):
            rows.append((conv, turn, ROLES[(conv + turn * 5) % len(ROLES)], TRICKY[(conv * 3 + turn) % len(TRICKY)]))
    rows += [(100, 0, "user", None), (100, 0, None, "x"), (100, None, "assistant", "first"), (None, 1, "user", "lost")]
    rows += [(101, 5, "assistant", "twice")] * 2 + [(102, k, "assistant", "long " * 20_000) for k in range(3)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1))
    done = chat.format_chat(df)
    back = done.select(
        "conv_id", "formatted", "loss_spans",
        chat.read_chat(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    want = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[conv].append((role or "", text or ""))
    found = back.collect()
    assert len(found) == len(want)
    for r in found:
        turns = [(t.role, t.text) for t in r.turns]
        assert turns == want[r.conv_id]
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in turns)
    assert chat.format_chat(df.limit(0)).count() == 0


def test_very_long_conversation(spark):
    """The work grows with the turns: 200,000 take seconds, and come back exactly."""
    n = 200_000
    text = F.concat(F.lit("[é\\"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")), F.col("id").cast("string"))
    role = F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")
    df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    begun = time.time()
    r = chat.format_chat(df).select(
        "loss_spans",
        chat.read_chat(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).select(F.size("loss_spans").alias("spans"), F.size("turns").alias("turns"), F.sha2("loss", 256).alias("loss")).first()
    assert time.time() - begun < 120
    loss = "".join("[é\\" + "x" * (k % 7) + str(k) for k in range(n) if k % 3)
    assert (r.turns, r.spans) == (n, sum(1 for k in range(n) if k % 3))
    assert r.loss == hashlib.sha256(loss.encode()).hexdigest()


def test_escaped_texts_hold_no_mark(spark):
    df = spark.createDataFrame([(t,) for t in TRICKY], "t string")
    got = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    marks = [m for pair in [*chat.MARKS.values(), chat.OTHER] for m in pair] + [chat.NAMED, chat.NEXT]
    assert all(r.t == r.u and not any(m in r.e for m in marks) for r in got)


def test_added_conversation(spark):
    row = QUERIES["op4_chat_format"](spark, FOLDER).where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    turns = f"user\n{text}\nassistant\n{text}\n"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
