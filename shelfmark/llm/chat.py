"""Conversations as one training text each, with a loss mask, and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# marks around the turns of a role; every mark starts with [ or <
MARKS = {
    "system": ("[SYS]", "[/SYS]"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("[OUT]", "</s>"),
}
OTHER = ("[ROLE]", "[/ROLE]")  # any other role; its name stands before NAMED
NAMED = "[:]"
NEXT = "[+]"  # between turns of one role that follow each other
LOSS_ROLE = "assistant"
BLOCK = 256  # turns
CHUNK = 512  # code points


def escape(text: Column) -> Column:
    """A backslash after every [, < and backslash, so that no text contains a mark."""
    return F.regexp_replace(text, r"([\[<\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<\\])\\", "$1")


def _by_role(role: Column, at: int) -> Column:
    found = [F.when(role == name, F.lit(marks[at])) for name, marks in MARKS.items()]
    other = F.lit(OTHER[at])
    if at == 0:
        other = F.concat(other, escape(role), F.lit(NAMED))
    return F.coalesce(*found, other)


def format_chat(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``.

    Turn structs are collected, sorted by turn, then role and text, and neighbours of one role
    merged into one block. ``loss_spans`` holds start (from 1) and length in code points of every
    text of the assistant, without marks. Lengths are summed up in blocks of ``BLOCK`` turns and then over the
    blocks, so the work grows with the turns.

    Null texts and roles are empty ones, a null turn comes first, rows without conv_id are one
    conversation; repeated rows are repeated turns. An empty table gives an empty result; other
    columns are ignored. A conversation is one row of the result and so one value in one task:
    it must fit a row, 2 GB at most.
    """
    turns = df.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def role_at(i: Column) -> Column:
        return F.get(F.col("turns"), i)["role"]

    def piece(t: Column, i: Column) -> Column:
        first = (i == 0) | (role_at(i - 1) != t["role"])
        last = (i == F.size("turns") - 1) | (role_at(i + 1) != t["role"])
        return F.struct(
            F.when(first, _by_role(t["role"], 0)).otherwise(F.lit(NEXT)).alias("before"),
            escape(t["text"]).alias("body"),
            F.when(last, _by_role(t["role"], 1)).otherwise(F.lit("")).alias("after"),
            (t["role"] == LOSS_ROLE).alias("loss"),
        )

    def add_span(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["before"])
        span = F.struct(start.alias("start"), F.length(p["body"]).cast("bigint").alias("length"))
        return F.struct(
            (start + F.length(p["body"]) + F.length(p["after"])).alias("at"),
            F.when(p["loss"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))

    def in_blocks(pieces: Column) -> Column:
        last = F.floor((F.size(pieces) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(pieces, b * BLOCK + 1, BLOCK))
        return F.transform(blocks, lambda block: F.aggregate(block, begin, add_span))

    def add_block(state: Column, block: Column) -> Column:
        own = F.struct(state["at"].alias("before"), block["spans"].alias("spans"))
        return F.struct(
            (state["at"] + block["at"]).alias("at"), F.concat(state["blocks"], F.array(own)).alias("blocks")
        )

    no_blocks = F.array().cast("array<struct<before:bigint,spans:array<struct<start:bigint,length:bigint>>>>")
    no_block = F.struct(F.lit(1).cast("bigint").alias("at"), no_blocks.alias("blocks"))
    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    joined = F.transform("pieces", lambda p: F.concat(p["before"], p["body"], p["after"]))
    placed = pieces.select(
        "conv_id",
        F.array_join(joined, "").alias("formatted"),
        F.aggregate(in_blocks(F.col("pieces")), no_block, add_block)["blocks"].alias("blocks"),
    )
    moved = F.transform(
        "blocks",
        lambda b: F.transform(
            b["spans"], lambda s: F.struct((b["before"] + s["start"]).alias("start"), s["length"].alias("length"))
        ),
    )
    return placed.select("conv_id", "formatted", F.flatten(moved).alias("loss_spans"))


def read_chat(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, as they were before merging."""
    ends = [marks[1] for marks in [*MARKS.values(), OTHER]]
    ended = "|".join(e.replace("[", r"\[").replace("]", r"\]") for e in ends)
    blocks = F.array_remove(F.split(formatted, ended), "")

    def from_place(b: Column, start: Column) -> Column:
        return b.substr(start, F.length(b)).alias("body")

    def block(b: Column) -> Column:
        known = [
            F.when(
                b.startswith(marks[0]),
                F.struct(F.lit(name).alias("role"), from_place(b, F.lit(len(marks[0]) + 1))),
            )
            for name, marks in MARKS.items()
        ]
        head = F.substring_index(b, NAMED, 1)
        named = F.struct(
            unescape(head.substr(F.lit(len(OTHER[0]) + 1), F.length(head))).alias("role"),
            from_place(b, F.length(head) + len(NAMED) + 1),
        )
        return F.coalesce(*known, named)

    def turns(b: Column) -> Column:
        return F.transform(
            F.split(b["body"], r"\[\+\]"),
            lambda p: F.struct(b["role"].alias("role"), unescape(p).alias("text")),
        )

    return F.flatten(F.transform(F.transform(blocks, block), turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    The text is cut in chunks of ``CHUNK`` code points once, so that no span is counted out from the
    start of the text.
    """

    def part(chunks: Column, s: Column) -> Column:
        place = s["start"] - 1
        first = F.floor(place / CHUNK).cast("int")
        count = F.floor((place + s["length"]) / CHUNK).cast("int") - first + 1
        near = F.array_join(F.slice(chunks, first + 1, count), "")
        return unescape(near.substr((place % CHUNK + 1).cast("int"), s["length"].cast("int")))

    # a list of one, so that the chunks are made once and not for every span
    cut = F.array(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))
    parts = F.transform(cut, lambda chunks: F.transform(spans, lambda s: part(chunks, s)))
    return F.array_join(F.flatten(parts), "")
