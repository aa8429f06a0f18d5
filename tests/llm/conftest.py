import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names the operators use for themselves
    T.StructField("score", T.StringType()), T.StructField("size", T.StringType()), T.StructField("ids", T.StringType()),
])


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text, source), with the other columns filled or null."""

    def documents(rows):
        full = [(i, t, "en" if t else None, s, len(t) if t else None, "x", None, "y") for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return documents


LONG = "word%d " * 30_000 % tuple(range(30_000))
AWKWARD = [
    (1, None, None), (2, "", "a"), (3, " \t\n", "a"), (4, "one", None), (5, LONG, "b"), (6, LONG, "b"),
    (7, "x" * 200_000, "a"), (7, "x" * 200_000, "a"), (None, "no id here at all", "b"), (None, None, "b"),
    (9, "tail é中\U0001f600\x00 end", "a"), (10, "one", "b"),
]


@pytest.fixture
def awkward(make):
    """Nulls, empty and very long texts, ties, repeated rows, odd characters."""
    return make(AWKWARD)
