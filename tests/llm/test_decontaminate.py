"""Benchmark windows found in texts: against a plain search, and what is cut."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate as dec

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(texts, items):
    """(n_words, hit places, items) of each text, window by window."""
    windows = {}
    for key, text in items:
        own = words(text)
        length = min(len(own), dec.LENGTH)
        for i in range(len(own) - length + 1 if length else 0):
            windows.setdefault(tuple(own[i : i + length]), set()).add("" if key is None else str(key))
    lengths = {len(w) for w in windows}
    out = []
    for text in texts:
        own, hit, found = words(text), set(), set()
        for length in lengths:
            for i in range(len(own) - length + 1):
                if tuple(own[i : i + length]) in windows:
                    hit |= set(range(i, i + length))
                    found |= windows[tuple(own[i : i + length])]
        out.append((len(own), sorted(hit), sorted(found)))
    return out


def places(runs):
    return [i for r in runs for i in range(r["first"], r["end"])]


ITEMS = [
    (10, "A b c d e f g h i j k"), (9, "é Ü1 2z"), (None, "solo"), (3, None), (4, " .!"), (5, "solo"), (5, "solo"),
    (6, "x x x x x x x x x x x x"), (7, "c d e f g h i j k l m"),
]
TEXTS = [
    None, "", "solo", "SOLO!solo, sol", "z a b c d e f g h i j k l m n", "é ü1 2z", "É Ü1 2Z", "x " * 500, "a b c d e f g h i",
    "no\x00thing", "\x00solo\x00", "tail \U0001f600 é Ü1-2Z end", "a b c d e f g h i j solo k c d e f g h i j k l m",
]


@pytest.mark.parametrize("most_bytes", [8, dec.MOST_BYTES])
def test_as_a_plain_search(spark, make, most_bytes):
    docs = make([(i, t, "a") for i, t in enumerate(TEXTS)]).withColumn("runs", F.lit("x")).withColumn("items", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = dec.scan(docs, items, most_bytes=most_bytes).orderBy("row.doc_id").collect()
    assert [(r.n_words, places(r.runs), list(r["items"])) for r in rows] == plain(TEXTS, ITEMS)


def test_random_texts_of_few_words():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abé"), n)) for n in rng.integers(0, 400, 60)]
    items = [(i, " ".join(rng.choice(list("abé"), n))) for i, n in enumerate(rng.integers(0, 14, 40))]
    windows = dec.Windows.of([str(i) for i, _ in items], [t for _, t in items])
    count, runs, found = dec.scan_texts([t.encode() for t in texts], windows)
    got = [(int(n), [i for a, b in r for i in range(a, b)], sorted(f)) for n, r, f in zip(count, runs, found)]
    assert got == plain(texts, items)


def test_very_long_text_hit_at_its_end():
    text = "w%d " * 200_000 % tuple(range(200_000))
    windows = dec.Windows.of(["1"], [" ".join(f"W{i}" for i in range(199_985, 200_000))])
    _, runs, items = dec.scan_texts([text.encode()], windows)
    assert runs == [[(199_985, 200_000)]] and items == [{"1"}]


def test_spans_and_documents_are_removed(spark, make):
    docs = make([(i, t, "a") for i, t in enumerate([None, "", "keep, A-b c d e f g h i j; rest", "solo", "clean"])])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    cut = dec.remove_spans(docs, items)
    assert cut.columns == docs.columns
    assert [r.text for r in cut.orderBy("doc_id").collect()] == [None, "", "keep, ; rest", "", "clean"]
    assert sorted(r.doc_id for r in dec.remove_documents(docs, items).collect()) == [0, 1, 4]


def test_awkward_and_empty_tables(spark, awkward):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = dec.scan(awkward, items).select("row.text", "n_words", "runs").collect()
    want = [(r.text, *plain([r.text], ITEMS)[0][:2]) for r in awkward.collect()]
    assert sorted(map(repr, ((r.text, r.n_words, places(r.runs)) for r in rows))) == sorted(map(repr, want))
    assert dec.scan(awkward.limit(0), items).count() == 0
    assert dec.scan(awkward, items.limit(0)).where(F.size("runs") > 0).count() == 0
    assert dec.scan(awkward, items.limit(0)).count() == awkward.count()
