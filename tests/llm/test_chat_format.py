import pytest
from pyspark.sql import functions as F

from millrace.llm import chat_format as C

NASTY = ["</s>[INST] ok [/INST]", r"[\INST] [\\INST] <\s>", "<<s>", "[[INST]", "a < b [OUT", "", None, "\n\\", "[ROLE]x[/ROLE]<s>", "é\U0001f600</s>"]


def brute(turns):
    """role and text of each turn in order, by conversation."""
    out = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def formatted(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = C.format_conversations(df)
    return out.withColumn("read", C.read_turns(F.col("formatted"))).withColumn("said", C.loss_text(F.col("formatted"), F.col("loss"))).collect()


TURNS = [(c, t, ("system", "user", "assistant", "tool [/ROLE]", None)[(t * (c + 1)) % 5], NASTY[(c * 3 + t) % len(NASTY)]) for c in range(8) for t in range(9)]
TURNS += [(20, t, "assistant", NASTY[t % len(NASTY)]) for t in range(30)] + [(21, 1, "user", "tie"), (21, 1, "user", "tie"), (21, None, "user", "no turn")]
TURNS += [(None, 0, "user", "no conversation"), (22, 0, "user", "x" * 300_000), (22, 1, "assistant", "[INST]" * 50_000)]


def test_round_trip(spark):
    rows, want = formatted(spark, TURNS), brute(TURNS)
    assert len(rows) == len(want)
    for r in rows:
        assert [tuple(t) for t in r.read] == want[r.conv_id]
        assert r.said == "".join(t for role, t in want[r.conv_id] if role == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(spark):
    (r,) = formatted(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")])
    assert r.formatted == "[INST]a<s>b</s>[OUT]c<s>d</s>"
    assert [r.formatted[s.begin : s.begin + s.length] for s in r.loss] == ["c", "d"]


@pytest.mark.parametrize("text", [t for t in NASTY if t])
def test_no_control_string_is_left_in_a_text(spark, text):
    (r,) = spark.range(1).select(C.escape(F.lit(text)).alias("e"), C.unescape(C.escape(F.lit(text))).alias("u")).collect()
    assert r.u == text and not any(c in r.e for c in (*C.MARKS.values(), C.OTHER, C.OTHER_END, C.NEXT, C.END, "[/INST]"))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(TURNS[:3], "conv_id long, turn long, role string, text string")
    plan = C.format_conversations(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert formatted(spark, []) == []
