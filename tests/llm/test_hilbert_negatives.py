"""Hard negatives: the curve, exact products, bounds, and whole results against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hilbert_negatives as neg

SCHEMA = "vec_id long, label int, embedding array<float>, score string, anchor string, lo int"


@pytest.mark.parametrize("dims, bits", [(2, 2), (3, 2), (4, 2), (2, 4)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)), np.uint8)
    keys = [k.tobytes() for k in neg.hilbert_keys(cells, bits)]
    order = sorted(range(len(cells)), key=keys.__getitem__)
    assert len(set(keys)) == len(cells)
    steps = np.abs(np.diff(cells[order].astype(int), axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("size", [100, 1 << 20, 1 << 29])
def test_products_are_exact(size):
    rng = np.random.default_rng(1)
    left, right = (rng.integers(-size, size, (n, 6)).astype(float) for n in (5, 7))
    want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left]
    assert neg.products(left, right).astype(np.int64).tolist() == want


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(2)
    anchors, rows = rng.normal(size=(20, 5)), rng.normal(size=(50, 5))
    low, high = neg.bounds(anchors, rows.min(axis=0), rows.max(axis=0))
    scores = anchors @ rows.T
    assert (scores >= low[:, None] - 1e-9).all() and (scores <= high[:, None] + 1e-9).all()


def brute(rows, every):
    usable = [
        (i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in usable:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, own) for j, own, w in usable]
        for p, positive, _ in sorted(s for s in scored if s[2] == label and s[1] != i)[:5]:
            window = sorted((s, j) for s, j, own in scored if own != label and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(i, positive, k + 1, j, -p, -s) for k, (s, j) in enumerate(window[:3])]
    return sorted(out)


def mined(spark, rows, every, **limits):
    table = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, neg.mine(table, F.col("vec_id") % every == 0, **limits).collect()))


def vectors(count, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    made = (centres[rng.integers(0, 6, count)] + 0.7 * rng.normal(size=(count, dims))) / 4
    return [(i, int(rng.integers(0, labels)), v.astype(np.float32).tolist()) for i, v in enumerate(made)]


@pytest.mark.parametrize("chunk_bytes", [neg.CHUNK_BYTES, 4096])
def test_whole_results(spark, chunk_bytes):
    rows = vectors(1500, 6, 3)
    want = brute(rows, 20)
    assert len(want) > 500
    assert mined(spark, rows, 20, chunk_bytes=chunk_bytes) == want


def test_ties_odd_rows_and_a_common_vector(spark):
    rows = vectors(120, 4, 4, 2)
    rows += [(1000 + i, i % 2, [0.5, 0.25, -0.5, 0.125]) for i in range(300)]
    rows += [
        (2000, None, [1.0] * 4), (2010, 1, None), (2020, 1, [1.0, None, 1.0, 1.0]), (2030, 1, [float("nan")] * 4),
        (2040, 0, [float("inf"), 1.0, 1.0, 1.0]), (None, 0, [1.0] * 4), (2050, 0, [0.0] * 4), (2060, 9, [9.0] * 4), (2070, 1, [0.5, 0.25]), (2080, 0, []),
    ]
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_empty_tables(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, 0, [1.0])], 10) == []
    assert mined(spark, [(10, None, None)], 10) == []


def test_most_blocks_are_passed_over_where_rows_lie_apart():
    rng = np.random.default_rng(6)
    anchors = {"vectors": rng.normal(size=(1, 8)) * 300}
    anchor = anchors["vectors"][0]
    best = neg.Best(np.array([[int(0.9 * anchor @ anchor)]]), np.array([[np.iinfo(np.int64).max]]), 5)
    near, far = (sign * anchor + rng.normal(size=(neg.BLOCK, 8)) for sign in (1, -1))
    wants = [best.wants(*neg.bounds(anchors["vectors"], m.min(axis=0), m.max(axis=0)))[0] for m in (near, far)]
    assert wants == [True, False]
