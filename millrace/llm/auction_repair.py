"""Conversation repair: faults of turns, and the cheapest edits to a legal order of roles.

The turns of a conversation, by turn number (nulls first, then role and text),
form a lattice: node (i, state) stands before row i, and ``state`` says what
the output ends with: nothing, a system, a user or an assistant turn. Arcs keep
(0), rerole (1) or delete (2) the row, or insert an empty user or assistant turn
(5); keeping a truncated row costs 5 more, and blank rows and duplicates can only
be deleted. A legal output is empty, or an optional system turn and then
user and assistant turns in pairs.

Shortest paths come from an auction: every node has a price, never more than an
arc's cost plus the price where it leads. A path is extended along an arc where the two are
equal (tight), or, where none is, its last node's price is raised to the
best offer and the path contracts. Nodes are settled from the last row to the
first, so a path ends at the first settled node. A row's prices depend on the row's
kind and on the next row's prices less their minimum, of which there are few:
they are kept. With all prices converged, following the tight arc of the least
letter from the first node gives the least of the cheapest edit strings.

One conversation is one value, as its repaired turns are. Rows are collected
once, with map-side aggregation; work and memory are linear in its turns.

Defined results: null roles and texts are one space; a null conversation id is
one conversation; null turns come first and leave no gap; a conversation
without rows has zeros, an empty audit and no turns; rows of the same turn come by role
and text; an empty table gives an empty result; other columns are dropped
and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
SPOKEN = {USER: "user", ASSISTANT: "assistant"}
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
TURN_AFTER = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # besides a first system turn
LEGAL_END = (NOTHING, ASSISTANT)
LEGAL_PAIRS = {"su", "ua", "au"}
STATES = 4
NEXT = STATES  # nodes of the next row are numbered from here
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
KINDS = 1 << 16  # prices kept in a worker
SCHEMA = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "turns array<struct<role: string, text: string>>"
)


def arcs(state: int, initial: str, fault: str) -> list[tuple[str, int, int]]:
    """(letter, cost, node) of what can be done at a row, least letter first."""
    found = [("D", DELETE, NEXT + state), ("I", INSERT, TURN_AFTER[state])]
    if fault in ("", "truncated"):
        more = TRUNCATED if fault else 0
        kept = STATE_OF.get(initial)
        if kept == TURN_AFTER[state] or (kept == SYSTEM and state == NOTHING):
            found.append(("K", more, NEXT + kept))
        found.append(("R", REROLE + more, NEXT + TURN_AFTER[state]))
    return found


END = NEXT  # behind the last row there is one node
END_ARCS = [
    [("", 0, END)] * (state in LEGAL_END) + [("I", INSERT, TURN_AFTER[state])] for state in range(STATES)
]


def settle(leaving: list[list[tuple[str, int, int]]], ahead: tuple[int, ...]) -> tuple[int, ...]:
    """The converged prices of a row's nodes; ``ahead`` are those of the nodes after it."""
    prices = [min(ahead)] * STATES + list(ahead)
    settled = set(range(NEXT, NEXT + len(ahead)))
    for origin in range(STATES):
        path = [origin]
        while path[-1] not in settled:
            node = path[-1]
            offer, to = min((cost + prices[to], to) for _, cost, to in leaving[node])
            if prices[node] < offer:
                prices[node] = offer
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        settled.update(path)
    return tuple(prices[:STATES])


END_PRICES = settle(END_ARCS, (0,))


@lru_cache(KINDS)
def settle_row(initial: str, fault: str, ahead: tuple[int, ...]) -> tuple[int, ...]:
    return settle([arcs(state, initial, fault) for state in range(STATES)], ahead)


def edits(rows: list[tuple[str, str]]) -> tuple[int, str, list[int]]:
    """Cost and letters of the cheapest edits of rows (initial, fault), and the state after each letter."""
    kinds = [(initial if initial in STATE_OF else "", fault) for initial, fault in rows]
    here, taken_off, priced = END_PRICES, 0, []
    for kind in reversed(kinds):
        low = min(here)
        taken_off += low
        ahead = tuple(p - low for p in here)
        here = settle_row(*kind, ahead)
        priced.append((here, ahead))
    cost = here[NOTHING] + taken_off
    letters, states, state = [], [], NOTHING
    for kind, (here, ahead) in zip(kinds, reversed(priced)):
        node = state
        while node < NEXT:  # one row's arcs, inserts first stay in the row
            letter, node = _tight(arcs(node, *kind), here + ahead, node)
            letters.append(letter)
            states.append(node % STATES)
        state = node - NEXT
    while True:
        letter, node = _tight(END_ARCS[state], (*END_PRICES, 0), state)
        if node == END:
            return cost, "".join(letters), states
        letters.append(letter)
        states.append(node)
        state = node


def _tight(leaving: list[tuple[str, int, int]], prices: tuple[int, ...], node: int) -> tuple[str, int]:
    return next((letter, to) for letter, cost, to in leaving if prices[node] == cost + prices[to])


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each (role, text), or the empty string."""
    found, seen = [], set()
    for row in rows:
        last = row[1].rstrip(SPACES)[-1:]
        if not last:
            found.append("blank")
        elif row in seen:
            found.append("duplicate")
        else:
            found.append("" if last in ".!?" else "truncated")
        seen.add(row)
    return found


def repair_turns(numbers: list[int | None], rows: list[tuple[str, str]]) -> dict:
    """What the columns of ``SCHEMA`` say of one conversation's ordered rows."""
    known = {n for n in numbers if n is not None}
    fault = faults(rows)
    initials = [role[:1] for role, _ in rows]
    cost, audit, states = edits(list(zip(initials, fault)))
    turns, left = [], iter(rows)
    for letter, state in zip(audit, states):
        role, text = next(left) if letter != "I" else ("", "")
        if letter != "D":
            turns.append({"role": role if letter == "K" else SPOKEN[state], "text": text})
    return {
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
        "blank": fault.count("blank"),
        "duplicate": fault.count("duplicate"),
        "truncated": fault.count("truncated"),
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "turns": turns,
    }


def damage(turns: DataFrame) -> DataFrame:
    """Rows of conversations made faulty by the checksum of ``conv_id:turn``: ``times`` says how often each occurs."""
    blank = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *named)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def repair(turns: DataFrame, times: Column | None = None) -> DataFrame:
    """One row per ``conv_id``: counts of faults, the edits' cost and letters, and the repaired ``turns``.

    ``times`` says how often a row occurs; a row of 0 only names its conversation.
    """
    blank = F.lit(" ")
    row = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    each = F.array_repeat(row, F.lit(1) if times is None else times)
    ordered = F.sort_array(F.flatten("rows"))
    found = turns.groupBy("conv_id").agg(F.collect_list(each).alias("rows")).select(
        "conv_id",
        ordered["turn"].alias("numbers"), ordered["role"].alias("roles"), ordered["text"].alias("texts"),
    )
    key = found.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                repair_turns(numbers.as_py(), list(zip(roles.as_py(), texts.as_py())))
                for numbers, roles, texts in zip(*batch.columns[1:])
            ]
            names = [f.split()[0] for f in SCHEMA.split(", turns")[0].split(", ")] + ["turns"]
            spoken = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            types = [pa.int64()] * 6 + [pa.string(), spoken]
            columns = [pa.array([m[name] for m in made], kind) for name, kind in zip(names, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["conv_id", *names])

    return found.mapInArrow(run, f"conv_id {key}, {SCHEMA}")
