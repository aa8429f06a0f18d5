import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from millrace.llm import bpe_fst, queries


@pytest.fixture(scope="module")
def tokens():
    return bpe_fst.read_ranks(queries.RANKS)


@pytest.fixture(scope="module")
def machine(tokens):
    return bpe_fst.Transducer(tokens, *bpe_fst.last_merges(tokens), queries.PATTERN, max_bytes=100_000)


@pytest.fixture(scope="module")
def library(tokens):
    ranks = {t: i for i, t in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(machine, text):
    return np.frombuffer(b"".join(machine.encode(text)), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_as_the_library(machine, library, text):
    assert ids(machine, text) == library.encode_ordinary(text)


def test_as_the_library_on_tokens_joined(machine, library, tokens):
    pick = random.Random(3)
    for _ in range(2000):
        text = b"".join(pick.choice(tokens) for _ in range(pick.randint(1, 6))).decode("utf-8", "ignore")
        assert ids(machine, text) == library.encode_ordinary(text), text


@pytest.mark.parametrize("unit", ["a", "ab", "the", "é", "0", "!", " ", "aaab"])
def test_long_matches_run_as_a_stream(machine, library, unit):
    text = unit * 9001
    parts = list(machine.run(text.encode()))
    assert len(parts) > 1  # given out in blocks
    assert [i for p in parts for i in p] == library._encode_single_piece(text)


def test_fixed_strings_of_special_tokens_are_text(machine, library):
    assert ids(machine, "a<|endoftext|>b") == library.encode_ordinary("a<|endoftext|>b")


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.integers(1, 5))
def test_incremental_utf8(data, step):
    stream = bpe_fst.Utf8Stream()
    got = "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.end()
    assert got.replace("�", "") == data.decode("utf-8", "replace").replace("�", "")
    if "�" not in data.decode("utf-8", "replace"):
        assert got == data.decode()


def test_decode_holds_back_split_characters(machine):
    text = "\U0001f600é中" * 50
    packed = b"".join(machine.encode(text))
    pieces = list(machine.decode([packed[i : i + 4] for i in range(0, len(packed), 4)], block=1))
    assert "".join(pieces) == text


def test_awkward_rows(awkward, library):
    out = bpe_fst.round_trip(awkward, queries.RANKS, queries.PATTERN, ["doc_id", "score"]).collect()
    rows = awkward.collect()
    assert sorted((r.doc_id or 0, r.decoded_sha256) for r in out) == sorted(
        (r.doc_id or 0, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows
    )
    by_id = {r.doc_id: r for r in out}
    want = np.array(library.encode_ordinary(rows[4].text), "<u4")
    assert by_id[5].n_tokens == len(want) and by_id[5].ids_sha256 == hashlib.sha256(want.tobytes()).hexdigest()
    assert by_id[2].n_tokens == 0 and all(r.score == "x" for r in out)


def test_empty_table(make):
    assert bpe_fst.encode_texts(make([]), queries.RANKS, queries.PATTERN, ["doc_id"]).collect() == []


def test_the_tables_are_flat(tokens):
    left, right = bpe_fst.last_merges(tokens)
    tracemalloc.start()
    machine = bpe_fst.Transducer(tokens, left, right, queries.PATTERN)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 12 << 20
    for token in [t for t in tokens if t][::97]:
        node = bpe_fst.ROOT
        for byte in token:
            node = machine.labels.find(byte, machine.first[node], machine.first[node + 1])
            assert node > 0
        assert tokens[machine.ends[node]] == token and machine.depth[node] == len(token)


def test_words_met_once_make_no_states(tokens, library):
    fresh = bpe_fst.Transducer(tokens, *bpe_fst.last_merges(tokens), queries.PATTERN)
    pick = random.Random(7)
    words = ["".join(pick.choices(["th", "er", "sch", "ó", "ent", "wh", "ou"], k=pick.randint(2, 9))) for _ in range(3000)]
    text = " ".join(words)
    assert ids(fresh, text) == library.encode_ordinary(text)
    assert len(fresh.states) == 1 and not fresh.moves  # a state for a word met once is never used again


def test_search_gives_up_places_that_fail(tokens, library):
    fresh = bpe_fst.Transducer(tokens, *bpe_fst.last_merges(tokens), queries.PATTERN)
    pick = random.Random(11)
    for _ in range(3000):  # joined tokens, where the longest first token is often wrong
        data = b"".join(pick.choice(tokens) for _ in range(pick.randint(1, 7)))[:256]
        assert fresh.short(data) == library._encode_single_piece(data), data
