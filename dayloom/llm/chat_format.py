"""Chat formatting by relational steps.

Turns are collected per conversation as structs, sorted, merged where neighbours share a
role, and concatenated. All of it is Spark expressions.

Template: a block per run of turns of one role,

    <s>role[INST]first text[/INST][INST]second text[/INST]</s>

Inside roles and texts a backslash is doubled and a control string gets a backslash after its
first character, so no text can open or close anything, and reading undoes both in one pass.

Defined results: a null text is empty, a null role is the empty role; turns of equal number
are ordered by role and text, and repeated rows stay repeated turns; a null conversation id is
a conversation of its own; a null turn sorts first; an empty table gives no rows; further
columns are ignored. A conversation is one string, so it must fit one row by its nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"(<|\[)(s>|/s>|INST\]|/INST\])"
OPEN, TURN, END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans``.

    ``loss_spans`` are (start, length) in code points of ``formatted``, from 0: each text of
    ``loss_role``, without the marks around it.
    """
    turns = conversations.groupBy(F.col(conv)).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col(turn).alias("turn"),
            escape(F.coalesce(F.col(role), F.lit(""))).alias("role"),
            escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
            F.coalesce(F.col(role) == loss_role, F.lit(False)).alias("loss"),
        ))).alias("turns")
    )
    # What each turn adds: an opening mark if the role changes before it, a closing mark if after.
    at = F.transform("turns", lambda t, i: F.struct(
        t["role"].alias("role"), t["text"].alias("text"), t["loss"].alias("loss"),
        F.coalesce(t["role"] != F.get("turns", i - 1)["role"], F.lit(True)).alias("first"),
        F.coalesce(t["role"] != F.get("turns", i + 1)["role"], F.lit(True)).alias("last"),
    ))
    pieces = F.transform("at", lambda t: F.struct(
        F.concat(F.when(t["first"], F.concat(F.lit(OPEN), t["role"])).otherwise(""), F.lit(TURN)).alias("before"),
        t["text"].alias("text"),
        F.concat(F.lit(END), F.when(t["last"], F.lit(CLOSE)).otherwise("")).alias("after"),
        t["loss"].alias("loss"),
    ))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state, p):
        start = state["at"] + F.length(p["before"])
        length = F.length(p["text"]).cast("long")
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct(
            (start + length + F.length(p["after"])).alias("at"),
            F.when(p["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return (
        turns.select(conv, at.alias("at")).select(conv, pieces.alias("pieces")).select(
            conv,
            F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), "").alias("formatted"),
            F.aggregate("pieces", empty, step, lambda s: s["spans"]).alias("loss_spans"),
        )
    )


def read_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text) in order."""
    blocks = F.filter(F.split(formatted, "</s>"), lambda b: b != "")

    def turns_of(block):
        role = unescape(F.substring_index(F.substring_index(block, TURN, 1), OPEN, -1))
        texts = F.split(block, r"\[/INST\]")
        inner = F.slice(texts, F.lit(1), F.size(texts) - 1)
        # Each piece ends with one text; what stands before its mark is the role or nothing.
        return F.transform(inner, lambda t: F.struct(
            role.alias("role"), unescape(F.substring_index(t, TURN, -1)).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
