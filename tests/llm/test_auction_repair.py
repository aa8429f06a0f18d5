"""Conversation repair against a search of all edits, and odd conversations."""

import itertools
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import auction_repair as repair

COST = {"K": 0, "R": 1, "D": 2, "I": 5}


def plain_edits(rows):
    """The least (cost, letters) of all edit strings with up to three inserts, and the role initials."""
    best = None

    def walk(i, cost, letters, said, inserts):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            best = min(best or (cost, letters, said), (cost, letters, said))
        if inserts < 3:
            for who in "ua":
                walk(i, cost + 5, letters + "I", said + who, inserts + 1)
        if i < len(rows):
            initial, fault = rows[i]
            walk(i + 1, cost + 2, letters + "D", said, inserts)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                walk(i + 1, cost + more, letters + "K", said + (initial or "?"), inserts)
                for who in "ua":
                    walk(i + 1, cost + 1 + more, letters + "R", said + who, inserts)

    walk(0, 0, "", "", 0)
    return best


KINDS = list(itertools.product(["s", "u", "a", "t"], ["", "truncated"])) + [("u", "blank")]


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_all_short_conversations(length):
    for rows in itertools.product(KINDS, repeat=length):
        cost, letters, said = plain_edits(rows)
        got = repair.edits(list(rows))
        assert got[:2] == (cost, letters), rows
        kept = "".join("?sua"[state] for letter, state in zip(got[1], got[2]) if letter != "D")
        assert kept == said


def test_prices_are_exact_distances():
    for rows in itertools.product(KINDS, repeat=2):
        cost = repair.edits(list(rows))[0]
        assert cost == plain_edits(rows)[0] <= 2 * len(rows)


def test_time_grows_with_the_turns():
    start = time.time()
    cost, letters, _ = repair.edits([("u", "")] * 100_000)
    assert (cost, len(letters)) == (50_000, 100_000) and set(letters) == {"K", "R"}
    assert time.time() - start < 20


ROWS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 4, "assistant", "Yes! "), (1, None, "system", "Be."),
    (None, None, None, None), (None, 3, "user", "cut"), (2, 5, "user", ""), (3, 1, "tool", "a?"), (3, 1, "tool", "a?"),
    (4, 0, "user", "x" * 1_000_000 + "."), (4, 1, "assistant", "é?\x0b\n"),
]


def test_defined_results(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumn("rows", F.lit(1)).withColumn("numbers", F.lit("x"))
    found = {r.conv_id: r for r in repair.repair(turns).collect()}
    assert set(found) == {None, 1, 2, 3, 4}
    one = found[1]  # the null turn comes first; the third assistant turn is legal when deleted
    assert (one.gaps, one.illegal, one.cost, one.audit) == (2, 1, 2, "KKDK")
    assert [t.role for t in one.turns] == ["system", "user", "assistant"] and one.turns[2].text == "Yes! "
    assert (found[None].gaps, found[None].blank, found[None].truncated, found[None].cost, found[None].audit) == (0, 1, 1, 4, "DD")
    assert (found[2].blank, found[2].cost, found[2].turns) == (1, 2, [])
    assert (found[3].duplicate, found[3].illegal, found[3].audit) == (1, 1, "DD")
    assert (found[4].cost, found[4].audit, len(found[4].turns[0].text)) == (0, "KK", 1_000_001)
    assert repair.repair(turns.limit(0)).count() == 0


def test_rows_that_only_name_a_conversation(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    none = repair.repair(turns, F.lit(0)).collect()
    assert len(none) == 5
    assert all((r.gaps, r.blank, r.illegal, r.cost, r.audit, r.turns) == (0, 0, 0, 0, "", []) for r in none)


def test_damage(spark):
    rows = [(c, t, "system", "A. b! c?") for c in range(12) for t in (None, *range(9))]
    turns = spark.createDataFrame([*rows, (None, None, None, None)], "conv_id long, turn long, role string, text string")
    for r in repair.damage(turns).collect():
        name = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = ("system", "A. b! c?") if r.conv_id is not None else (" ", " ")
        want = ("user" if kind == 4 else role, {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(kind, text))
        assert (r.role, r.text) == want and r.times == {0: 0, 3: 2}.get(kind, 1)
