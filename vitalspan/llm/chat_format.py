"""Conversations as one marked text each, with a mask of what is trained on.

Turns are collected as structs and sorted by turn, role and text. A turn opens a block if its role
differs from that of the turn before, and closes it if it differs from that of the next, so that
adjacent turns of one role share a block; the pieces are joined as an array. A block is

    <s>role[INST]text[/INST][INST]text[/INST]</s>

In roles and texts ``&``, ``<`` and ``[`` are written as entities, so that no control string can
occur there and every text can be read back. All is made of Spark's own expressions.

Null texts and roles are empty; null turns come first, and rows without a conversation form one
of their own. Turns with equal numbers are ordered by role and text, repeated rows are turns of
their own. An empty table gives no conversations. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings, and what stands for their first characters in a text.
BLOCK, BLOCK_END, TEXT, TEXT_END = "<s>", "</s>", "[INST]", "[/INST]"
ENTITIES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]

#: Between any control string and its neighbours.
_EDGES = r"(?<=<s>|</s>|\[INST\]|\[/INST\])|(?=<s>|</s>|\[INST\]|\[/INST\])"


def escaped(value: Column) -> Column:
    for character, entity in ENTITIES:
        value = F.replace(value, F.lit(character), F.lit(entity))
    return value


def unescaped(value: Column) -> Column:
    for character, entity in reversed(ENTITIES):
        value = F.replace(value, F.lit(entity), F.lit(character))
    return value


def _segments(turns: Column, trained: str) -> Column:
    """Control strings, roles and texts in order, each with its place in the loss mask."""

    def of(turn: Column, i: Column) -> Column:
        before = F.try_element_at(turns, F.when(i > 0, i))["role"]
        after = F.try_element_at(turns, i + 2)["role"]
        part = lambda text, when, loss=False: F.struct(
            F.when(when, text).otherwise(F.lit("")).alias("text"), F.lit(loss).alias("loss")
        )
        opens, closes = ~before.eqNullSafe(turn["role"]), ~after.eqNullSafe(turn["role"])
        always = F.lit(True)
        return F.array(
            part(F.lit(BLOCK), opens),
            part(escaped(turn["role"]), opens),
            part(F.lit(TEXT), always),
            F.struct(
                escaped(turn["text"]).alias("text"), (turn["role"] == trained).alias("loss")
            ),
            part(F.lit(TEXT_END), always),
            part(F.lit(BLOCK_END), closes),
        )

    return F.filter(F.flatten(F.transform(turns, of)), lambda s: s["text"] != "")


def format_chats(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``mask``: runs of characters with or without loss."""
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    parts = sorted_turns.select("conv_id", _segments(F.col("turns"), trained).alias("parts"))
    return parts.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"),
        F.transform(
            "parts",
            lambda p: F.struct(F.char_length(p["text"]).alias("chars"), p["loss"].alias("loss")),
        ).alias("mask"),
    )


def read_turns(formatted: Column) -> Column:
    """Role and text of each turn of a formatted conversation."""

    def of(block: Column) -> Column:
        parts = F.split(block, r"\[INST\]", -1)
        role = unescaped(F.substring(parts[0], len(BLOCK) + 1, 1 << 30))
        texts = F.slice(parts, F.lit(2), F.size(parts) - 1)
        return F.transform(
            texts,
            lambda t: F.struct(
                role.alias("role"), unescaped(F.replace(t, F.lit(TEXT_END), F.lit(""))).alias("text")
            ),
        )

    blocks = F.split(formatted, BLOCK_END, -1)
    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), of))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    segments = F.filter(F.split(formatted, _EDGES, -1), lambda s: s != "")
    both = F.zip_with(
        segments, mask, lambda s, m: F.struct(s.alias("text"), m["chars"].alias("n"), m["loss"].alias("loss"))
    )
    held = F.filter(both, lambda b: b["loss"])
    return F.array_join(
        F.transform(held, lambda b: unescaped(F.substr(b["text"], F.lit(1), b["n"]))), ""
    )


def digests(chats: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    read = chats.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("mask")).alias("loss"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
