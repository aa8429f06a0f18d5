import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash_anchor as S


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def plain_components(fps, threshold):
    """Brute force: each fingerprint's smallest reachable index."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if bin(a ^ b).count("1") <= threshold and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_golay_covers():
    code, random = S.Golay(), np.random.default_rng(1)
    words = random.integers(0, 1 << 23, 3000)
    home = words ^ code.home[code.syndrome(words)]
    assert (code.syndrome(home) == 0).all() and (np.bitwise_count(home ^ words) <= S.RADIUS).all()
    flipped = words ^ (1 << random.integers(0, 23, 3000))
    around = flipped[:, None] ^ code.around[code.syndrome(flipped)]
    assert (around == home[:, None]).any(1).all()  # a neighbour's home is among the anchors around


@pytest.mark.parametrize("threshold", [0, 3, 4, 5])
def test_links_connect_what_brute_force_connects(spark, threshold):
    random = np.random.default_rng(threshold)
    fps = random.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2)
    near = []
    for fp in fps[:40]:
        for flips in range(8):
            bits = random.choice(64, flips, replace=False)
            near.append(fp ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64)) if flips else fp)
    every = sorted({int(x) for x in [*fps, *near]})
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in every], "fp long")
    root = {r.node: r.root for r in S.components(S.links(df, threshold)).collect()}
    signed = [int(np.uint64(x).view(np.int64)) for x in every]
    got = [root.get(x, x) for x in signed]
    want = plain_components(every, threshold)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_anchors_dealt_to_a_grid_lose_nothing(spark, monkeypatch):
    random = np.random.default_rng(9)
    base = random.integers(0, 1 << 63, 1, dtype=np.uint64)[0]
    fps = sorted({int(base ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b))) for a in range(30) for b in range(30)})
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    assert S.links(df).count() < 19 * len(fps)  # a forest for each anchor, not all pairs
    monkeypatch.setattr(S, "HOMES", 7)
    monkeypatch.setattr(S, "GUESTS", 11)
    root = {r.node: r.root for r in S.components(S.links(df)).collect()}
    assert len(root) == len(fps) and len(set(root.values())) == 1


def test_components_of_a_long_chain(spark):
    edges = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert S.components(edges).agg(F.min("root"), F.max("root"), F.count("*")).first()[:] == (0, 0, 401)


def test_awkward_rows(awkward):
    rows = awkward.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    label = plain_components(fps, S.THRESHOLD)
    low = {}
    for r, part in zip(rows, label):
        if r.doc_id is not None:
            low[part] = min(low.get(part, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), fp, low.get(part)) for r, fp, part in zip(rows, fps, label))
    got = sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in S.groups(awkward).collect())
    assert got == want


def test_one_row_of_each_group_stays(make):
    text = " ".join(f"w{i}" for i in range(400))
    docs = make([(5, text, "a"), (3, text + " more", "b"), (8, "quite another text is here", "a"), (3, "and a third one here", "a")])
    out = S.representatives(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.source) for r in out.collect()) == [(3, "a"), (3, "b"), (8, "a")]


def test_empty_table(make):
    assert S.groups(make([])).collect() == [] and S.representatives(make([])).collect() == []
