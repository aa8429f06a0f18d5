from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup


def weak(text):
    """A digest of three values, so that different texts share it."""
    return F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))


def expected(rows):
    by_text = defaultdict(list)
    for r in rows:
        by_text[r.text or ""].append(r.doc_id)
    out = []
    for ids in by_text.values():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_groups(awkward, digest):
    got = exact_dedup.groups(awkward, digest=digest, salts=3).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == expected(awkward.collect())


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_distinct_rows_keeps_whole_rows(awkward, digest):
    out = exact_dedup.distinct_rows(awkward, digest=digest)
    assert out.columns == awkward.columns
    got = {(r.text or ""): r for r in out.collect()}
    assert len(got) == out.count() == len({r.text or "" for r in awkward.collect()})
    assert got["one"].doc_id == 10 and got["one"].source == "b" and got["one"].score == "x"
    assert got["x" * 200_000].doc_id == 7 and got[""].doc_id == 2


def test_hot_text(make):
    rows = [(i, "same" if i % 3 else f"own {i}", "a") for i in range(3000)]
    got = exact_dedup.groups(make(rows)).where("group_size > 1").agg(F.count("*"), F.max("keep_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (2000, 2999, 1)


def test_empty_table(make):
    assert exact_dedup.groups(make([])).collect() == [] and exact_dedup.distinct_rows(make([])).collect() == []
