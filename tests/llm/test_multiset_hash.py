import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import multiset_hash as M

LINES = st.lists(st.text(alphabet="ab é\t", max_size=6), min_size=1, max_size=6)


@settings(max_examples=100, deadline=None)
@given(LINES, st.randoms())
def test_order_does_not_matter_and_repeats_do(lines, random):
    shuffled = random.sample(lines, len(lines))
    assert M.fingerprint("\n".join(lines)) == M.fingerprint("\n".join(shuffled))
    assert M.fingerprint("\n".join(lines)) != M.fingerprint("\n".join([*lines, lines[0]]))


@settings(max_examples=100, deadline=None)
@given(LINES, LINES)
def test_insertion_and_deletion(first, second):
    hasher = M.Hasher()
    both = hasher.vector([*first, *second])
    less = M.subtract(both, hasher.vector(second))
    assert M.packed(less) == M.fingerprint("\n".join(first))
    assert M.packed(M.add(less, hasher.vector(second))) == M.packed(both)


def test_likeness_follows_what_is_shared():
    random = np.random.default_rng(4)
    words = [f"w{i}" for i in random.integers(0, 10**9, 8000)]
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        cut = int(4000 * share)
        a, b = words[:4000], words[:cut] + words[4000 : 8000 - cut]
        like = M.likeness(M.unpacked(M.fingerprint(" ".join(a))), M.unpacked(M.fingerprint(" ".join(b))))
        assert abs(like - share) < 0.2


@pytest.mark.parametrize("repeats", [1_000, 32_769, 100_000])
def test_likeness_of_long_runs_of_one_word(repeats):
    text, other = "a " * repeats, " ".join(f"w{i}" for i in range(repeats))
    cut = M.replaced(text)
    new = text[: len(text) - cut] + other[:cut]
    assert M.likeness(M.unpacked(M.fingerprint(text)), M.unpacked(M.fingerprint(new))) > 0.9


def test_next_document_of_a_long_run(make):
    text, other = "a " * 100_000, " ".join(f"w{i}" for i in range(100_000))
    rows = {r.doc_id: r for r in M.compare_edits(make([(1, text, "a"), (2, other, "a")]), ranges=1).collect()}
    assert rows[1].near_edited > 0.9


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (key, text, _) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 4
        new = text[: len(text) - cut] + after[:cut]
        out.append((str(key), len(text), hashlib.sha256(new.encode()).hexdigest(), M.fingerprint(text), M.fingerprint(new)))
    return sorted(out)


def result(docs, ranges):
    rows = M.compare_edits(docs, ranges=ranges).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in rows)


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_against_brute_force(awkward, ranges):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    assert result(awkward, ranges) == brute(rows)


@pytest.mark.parametrize("ranges", [1, 5, 16])
def test_next_over_ranges(make, ranges):
    rows = [(i * 7 % 101, f"text {i}\nline {i * i}\n" * (i % 5 + 1), "a") for i in range(101)]
    assert result(make(rows), ranges) == brute(rows)


def test_single_document_and_empty_table(make):
    assert result(make([(4, "abcdefgh", "a")]), 3) == brute([(4, "abcdefgh", "a")])
    assert M.compare_edits(make([]), ranges=3).collect() == []
