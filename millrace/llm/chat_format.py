"""Chat formatting with array expressions only.

The turns of a conversation are collected as structs and sorted; adjacent
turns of one role become one block; blocks are concatenated. A block is its
role's mark, its texts parted by ``<s>``, and ``</s>``.

Control strings inside a text get one backslash more after their first
character than they had (``[INST]`` becomes ``[\\INST]``), so none without a
backslash is left, and reading back takes one away. Control strings have
their bracket only in front, so text and mark never form a new one together.

The loss mask is a list of code-point spans, one for each assistant text.

Defined results: a null text or role is empty; a null conversation id is one
conversation; turns are sorted by (turn, role, text), nulls first, so ties and
repeated rows have a fixed place; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the template.
MARKS = {"system": "[SYS]", "user": "[INST]", "assistant": "[OUT]"}
OTHER, OTHER_END = "[ROLE]", "[/ROLE]"
NEXT, END = "<s>", "</s>"
CONTROL = r"(/?(?:INST|SYS|OUT|ROLE)\]|/?s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<]\\*){CONTROL}", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<]\\*)\\{CONTROL}", "$1$2")


def mark(role: Column) -> Column:
    out = F.concat(F.lit(OTHER), escape(role), F.lit(OTHER_END))
    for name, fixed in MARKS.items():
        out = F.when(role == name, F.lit(fixed)).otherwise(out)
    return out


def format_conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key``, ``formatted`` and ``loss`` (spans: begin, length) of each conversation."""
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sorted_turns = turns.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    size = F.size("_turns")
    at = lambda i: F.element_at("_turns", (i + 1).cast("int"))
    runs = sorted_turns.withColumn(
        "_first",  # where each block of one role begins
        F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (at(i)["role"] != at(F.greatest(i - 1, F.lit(0)))["role"])),
    )
    blocks = runs.withColumn(
        "_blocks",
        F.transform("_first", lambda i, k: F.struct(
            at(i)["role"].alias("role"),
            F.transform(
                F.slice("_turns", i + 1, F.coalesce(F.get("_first", k + 1), size) - i), lambda t: escape(t["text"])
            ).alias("texts"),
        )),
    )
    merged = blocks.withColumn(
        "_merged",
        F.transform("_blocks", lambda b: F.struct(
            b["role"].alias("role"), mark(b["role"]).alias("mark"),
            F.transform(b["texts"], F.char_length).alias("lengths"), F.array_join(b["texts"], NEXT).alias("text"),
        )),
    )
    pieces = F.transform("_merged", lambda b: F.concat(b["mark"], b["text"], F.lit(END)))
    span = "struct<begin:int,length:int>"
    inside = lambda acc, n: F.struct(
        F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("begin"), n.alias("length")))).alias("spans"),
        (acc["at"] + n + len(NEXT)).alias("at"),
    )
    block = lambda acc, b: F.when(
        b["role"] == "assistant",
        F.struct(
            F.aggregate(
                b["lengths"], F.struct(acc["spans"].alias("spans"), (acc["at"] + F.char_length(b["mark"])).alias("at")), inside
            )["spans"].alias("spans"),
            (acc["at"] + F.char_length(b["mark"]) + F.char_length(b["text"]) + len(END)).alias("at"),
        ),
    ).otherwise(F.struct(
        acc["spans"].alias("spans"),
        (acc["at"] + F.char_length(b["mark"]) + F.char_length(b["text"]) + len(END)).alias("at"),
    ))
    start = F.struct(F.array().cast(f"array<{span}>").alias("spans"), F.lit(0).alias("at"))
    return merged.select(
        key, F.array_join(pieces, "").alias("formatted"), F.aggregate("_merged", start, block)["spans"].alias("loss")
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    whole = F.split(formatted, END, -1)
    blocks = F.slice(whole, 1, F.size(whole) - 1)
    named = r"(?s)^\[ROLE\](.*?)\[/ROLE\]"

    def turns_of(block: Column) -> Column:
        role = unescape(F.regexp_extract(block, named, 1))
        begin = F.char_length(F.regexp_extract(block, named, 0))
        for name, fixed in MARKS.items():
            here = F.startswith(block, F.lit(fixed))
            role, begin = F.when(here, F.lit(name)).otherwise(role), F.when(here, F.lit(len(fixed))).otherwise(begin)
        texts = F.split(F.substring(block, begin + 1, F.char_length(block)), NEXT, -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["begin"] + 1, s["length"]))), "")
