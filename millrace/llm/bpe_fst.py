"""Byte-level BPE as a finite-state transducer over the token trie.

The rank file is compiled once on the driver: a byte trie of all tokens, and
for each token the two parts of its last merge. A sequence of tokens is what
BPE yields exactly if BPE leaves each neighbouring pair as it is, so a
transducer whose state is (last token, trie node) accepts one path per input.

Short matches, which are at hand whole, are searched for that path depth first:
the longest token that may follow the last one, a shorter one if that leads
nowhere. Only one path leads to a place, so a place that failed fails for good.

Very long matches are read as a stream by the same machine, determinised while
it runs: a state lists all places where a token may have begun, and each byte
read gives the one token that would be the last if the input ended there. Such
a place dies when no token continues it, so a border is settled after less
bytes than the longest token has, and the tokens before the last settled border
are emitted. States are made on first use; words do not use them, since most
that are not remembered are rare and would make states that nothing else needs.

What a machine remembers is counted in bytes: half of ``max_bytes`` for states,
moves, pairs and heads, forgotten together; half for the ids of words met, of
which those not met again for a while go. All of it goes when a task ends.

Defined results: null counts as the empty text (no ids); an empty table gives
an empty result; repeated rows are encoded each; very long matches run
through the transducer as a stream and are not remembered.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.texts import map_texts

ROOT = 0
NEVER = 1 << 30
HEAD = 3  # bytes by which the search remembers where the trie leads


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id from a rank file (base64 token, blank, rank)."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranked.get(i, b"") for i in range(max(ranked) + 1)]


def last_merges(tokens: list[bytes]) -> tuple[list[int], list[int]]:
    """For each token the ids of the two parts its last merge joins; itself for single bytes."""
    rank = {t: i for i, t in enumerate(tokens) if t}
    left, right = list(range(len(tokens))), list(range(len(tokens)))
    for token, own in rank.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((rank.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            left[own], right[own] = rank[parts[0]], rank[parts[1]]
    return left, right


class Transducer:
    """Text to ids by the ranks in ``tokens``; ids to text."""

    def __init__(
        self, tokens: list[bytes], left: list[int], right: list[int], pattern: str,
        max_bytes: int = 96 << 20, max_word: int = 64,
    ) -> None:
        self.tokens, self.left, self.right = tokens, left, right
        self.split = regex.compile(pattern)
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self.max_bytes, self.max_word = max_bytes, max_word
        self.length = [len(t) for t in tokens]
        self.plant()
        self.words = Words(self)
        self.plain_split, self.not_plain = plain_twin(pattern)
        self.forget()

    def plant(self) -> None:
        """The trie, level by level: a node's children are neighbours, ``first``
        says from where, and ``labels`` holds the byte that leads to each node.
        ``shorter`` gives for each token the longest other one it begins with."""
        ordered = sorted(self.rank)
        labels, self.first, self.ends, self.depth = bytearray(1), array("i"), array("i", [-1]), array("i", [0])
        low, high = array("i", [0]), array("i", [len(ordered)])  # the tokens at and below a node
        above, self.shorter = array("i", [-1]), array("i", [-1]) * len(self.tokens)
        node = ROOT
        while node < len(low):
            at, end, depth, longest = low[node], high[node], self.depth[node], above[node]
            self.first.append(len(low))
            if at < end and len(ordered[at]) == depth:
                token = self.ends[node] = self.rank[ordered[at]]
                self.shorter[token], longest = longest, token
                at += 1
            while at < end:
                byte = ordered[at][depth]
                labels.append(byte)
                self.ends.append(-1)
                self.depth.append(depth + 1)
                above.append(longest)
                low.append(at)
                while at < end and ordered[at][depth] == byte:
                    at += 1
                high.append(at)
            node += 1
        self.first.append(len(low))
        self.labels = bytes(labels)

    # --- which tokens may follow each other ---------------------------------

    def spine(self, token: int) -> tuple[list, list]:
        """Pieces at the token's end and start, innermost first, each with the
        rank of the merge that absorbs it."""
        if token not in self.spines:
            both = []
            for side in (self.right, self.left):
                pieces, piece, absorbed = [], token, NEVER
                while True:
                    pieces.append((self.tokens[piece], absorbed))
                    if side[piece] == piece:
                        break
                    piece, absorbed = side[piece], piece
                both.append(pieces[::-1])
            self.spines[token] = (both[0], both[1])
            self.used += 250 + 100 * (len(both[0]) + len(both[1]))
        return self.spines[token]

    def may_follow(self, first: int, second: int) -> bool:
        """Whether BPE over both tokens' bytes leaves just these two tokens:
        at no time does a merge across the border come before the merge that
        absorbs either piece next to the border."""
        key = first << 32 | second
        known = self.pairs.get(key)
        if known is None:
            ends, starts = self.spine(first)[0], self.spine(second)[1]
            i = j = 0
            known = True
            while True:
                (a, a_gone), (b, b_gone) = ends[i], starts[j]
                across = self.rank.get(a + b, NEVER)
                if across < a_gone and across <= b_gone and across != NEVER:
                    known = False
                    break
                if a_gone == NEVER and b_gone == NEVER:
                    break
                if a_gone <= b_gone:  # of equal merges the left one comes first
                    i += 1
                else:
                    j += 1
            self.pairs[key] = known
            self.used += 80
        return known

    # --- the search for short matches ---------------------------------------

    def head(self, ahead: bytes) -> tuple[int, int]:
        """Where up to ``HEAD`` bytes lead in the trie (-1: no token is longer),
        and the longest token they begin with."""
        first, node, token = self.first, ROOT, -1
        for byte in ahead:
            node = self.labels.find(byte, first[node], first[node + 1])
            if node < 0:
                break
            if self.ends[node] >= 0:
                token = self.ends[node]
        if node >= 0 and first[node] == first[node + 1]:
            node = -1
        self.heads[ahead] = node, token
        self.used += 250
        return node, token

    def short(self, data: bytes) -> list[int]:
        """The ids of a match of few bytes, depth first."""
        if 2 * self.used > self.max_bytes:
            self.forget()
        find, first, ends, length, shorter = self.labels.find, self.first, self.ends, self.length, self.shorter
        heads, pairs = self.heads.get, self.pairs.get
        ids: list[int] = []
        dead: set[int] = set()  # places that no path leaves
        at, size = 0, len(data)
        while at < size:
            ahead = data[at : at + HEAD]
            node, token = heads(ahead) or self.head(ahead)
            if node >= 0:
                for byte in data[at + HEAD :]:
                    node = find(byte, first[node], first[node + 1])
                    if node < 0:
                        break
                    if ends[node] >= 0:
                        token = ends[node]
            while True:
                if token < 0:  # the last token was too long
                    dead.add(at)
                    token = ids.pop()
                    at -= length[token]
                elif at + length[token] not in dead:
                    if not ids:
                        break
                    fits = pairs(ids[-1] << 32 | token)
                    if fits or fits is None and self.may_follow(ids[-1], token):
                        break
                token = shorter[token]
            ids.append(token)
            at += length[token]
        return ids

    # --- the determinised machine -------------------------------------------

    def forget(self) -> None:
        self.spines: dict[int, tuple[list, list]] = {}
        self.pairs: dict[int, bool] = {}  # by 2**32 * first + second
        self.heads: dict[bytes, tuple[int, int]] = {}
        self.numbers: dict[bytes, int] = {}
        self.states: list[bytes] = []  # packed pairs of token and node
        self.last = array("i")  # by state: the last token if the input ended there
        self.moves: dict[int, int] = {}  # by state + byte; states count in steps of 256
        self.used = 0  # bytes, about
        self.start = self.number(array("i", [-1, ROOT]).tobytes())

    def empty(self) -> None:
        """Nothing is remembered but the compiled tables."""
        self.forget()
        self.words.forget()

    def number(self, state: bytes) -> int:
        known = self.numbers.setdefault(state, len(self.states) << 8)
        if known == len(self.states) << 8:
            self.states.append(state)
            self.last.append(array("i", state)[-2])
            self.used += 180 + len(state)
        return known

    def move(self, state: int, byte: int) -> int:
        """The next state. Its last pair begins with the last token of what has been read by then.

        A state lists, for each place where a token may have begun, the token
        before that place and the trie node reached since."""
        find, first, ends, pairs = self.labels.find, self.first, self.ends, self.pairs
        alive, ended = array("i"), -1
        here = iter(array("i", self.states[state >> 8]))
        for last, node in zip(here, here):
            into = find(byte, first[node], first[node + 1])
            if into < 0:
                continue
            if ended < 0:
                token = ends[into]
                if token >= 0:
                    fits = last < 0 or pairs.get(last << 32 | token)
                    if fits or fits is None and self.may_follow(last, token):
                        ended = token
            if first[into] < first[into + 1]:
                alive.append(last)
                alive.append(into)
        alive.append(ended)
        alive.append(ROOT)
        made = self.moves[state + byte] = self.number(alive.tobytes())
        self.used += 100
        return made

    def run(self, data: bytes, block: int = 1 << 12) -> Iterator[list[int]]:
        """The ids of one match of the pattern, given out as soon as a block is settled."""
        if 2 * self.used > self.max_bytes:
            self.forget()
        state, moves, states, last = self.start, self.moves, self.states, self.last
        lasts: list[int] = []  # for each byte not settled: the last token if the match ended there
        for at in range(0, len(data), block):
            for byte in data[at : at + block]:
                step = moves.get(state + byte)
                state = self.move(state, byte) if step is None else step
                lasts.append(last[state >> 8])
            if at + block < len(data):
                done = self.settled(states[state >> 8], lasts)
                yield self.back(lasts, done)
                del lasts[:done]
                if 2 * self.used > self.max_bytes:
                    here = states[state >> 8]
                    self.forget()
                    state, moves, states, last = self.number(here), self.moves, self.states, self.last
        yield self.back(lasts, len(lasts))

    def back(self, lasts: list[int], at: int) -> list[int]:
        """The tokens of the first ``at`` bytes, found from their end."""
        ids, length = [], self.length
        while at > 0:
            ids.append(lasts[at - 1])
            at -= length[ids[-1]]
        return ids[::-1]

    def settled(self, state: bytes, lasts: list[int]) -> int:
        """The last border that lies on the paths of all places where a token may have begun."""
        common: set[int] | None = None
        for node in array("i", state)[1::2]:
            at = len(lasts) - self.depth[node]
            borders = {at}
            while at > 0:
                at -= self.length[lasts[at - 1]]
                borders.add(at)
            common = borders if common is None else common & borders
        return max(common or {0})

    # --- whole texts ----------------------------------------------------------

    def matches(self, text: str, block: int = 1 << 16) -> Iterator[list[str]]:
        """The pattern's matches, in blocks."""
        split = self.plain_split if self.plain_split and not self.not_plain.search(text) else self.split
        if len(text) <= block * 16:
            yield split.findall(text)
            return
        found = (m.group() for m in split.finditer(text))
        while some := list(islice(found, block)):
            yield some

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as packed little-endian unsigned 32-bit integers, block by block."""
        for some in self.matches(text):
            yield b"".join(map(self.words.__getitem__, some))

    def pieces(self, packed: bytes, block: int = 1 << 14) -> Iterator[bytes]:
        """Bytes of packed ids, some ids at a time."""
        token = self.tokens.__getitem__
        ids = np.frombuffer(packed, dtype="<u4")
        for at in range(0, len(ids), block):
            yield b"".join(map(token, ids[at : at + block].tolist()))

    def decode(self, packed: Iterable[bytes], block: int = 1 << 14) -> Iterator[str]:
        """Text of packed ids, block by block; no block ends inside a character."""
        stream = Utf8Stream()
        for part in packed:
            for piece in self.pieces(part, block):
                yield stream.feed(piece)
        yield stream.end()


class Words(dict):
    """Packed ids of the matches met lately; ``before`` holds those met before
    them. Each of the two takes a quarter of the machine's bytes at most."""

    def __init__(self, machine: Transducer) -> None:
        self.machine = machine
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.before: dict[str, bytes] = {}
        self.used = 0

    def __missing__(self, match: str) -> bytes:
        packed = self.before.get(match)
        if packed is None:
            machine = self.machine
            if len(match) > machine.max_word:
                return b"".join([array("I", ids).tobytes() for ids in machine.run(match.encode())])
            packed = array("I", machine.short(match.encode())).tobytes()
        if 4 * self.used > self.machine.max_bytes:
            self.before = dict(self)
            self.clear()
            self.used = 0
        self[match] = packed
        self.used += 180 + len(match) + len(packed)
        return packed


def plain_twin(pattern: str) -> tuple[re.Pattern, re.Pattern] | tuple[None, None]:
    """The pattern in ``re``'s terms, and a pattern that finds characters below
    U+3000 on whose class the two engines differ, or characters above it.

    ``re`` takes half the time, so texts without such characters use it."""
    twin = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    if r"\p" in twin or r"\P" in twin:
        return None, None
    below = "".join(map(chr, range(0x3000)))
    agreed = set(below)
    for own, other in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s")):
        agreed -= set(regex.findall(own, below)) ^ set(re.findall(other, below))
    return re.compile(twin), re.compile("[^" + "".join(map(re.escape, sorted(agreed))) + "]")


class Utf8Stream:
    """Incremental UTF-8: its state is the bytes of a character begun but not
    ended. Bytes that can never become a character turn into U+FFFD."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:  # a lead byte: how many bytes belong to it
                if back < (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4):
                    keep -= back
                break
            if byte < 0x80:
                break
        self.held = data[keep:]
        return data[:keep].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


_of_worker: dict[tuple, Transducer] = {}


def shared(spark: SparkSession, ranks_path: str, pattern: str):
    """A function that gives the transducer in a task. The compiled tables
    (about 50,000 tokens, a few MB: their size is the vocabulary's) are
    broadcast; a Python worker keeps the tables, not what it met, from task to task."""
    tokens = read_ranks(ranks_path)
    sent = spark.sparkContext.broadcast((tokens, *(array("i", side) for side in last_merges(tokens))))
    key = (ranks_path, pattern)

    def here() -> Transducer:
        if key not in _of_worker:
            _of_worker[key] = Transducer(*sent.value, pattern)
        return _of_worker[key]

    return here


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit
    integers) and ``decoded_sha256`` of each whole text: the digest of what its
    ids, decoded as a stream, give back."""
    here = shared(df.sparkSession, ranks_path, pattern)

    def rows(texts: list[str]) -> dict[str, list]:
        machine = here()
        out: dict[str, list] = {"n_tokens": [], "ids": [], "decoded_sha256": []}
        for t in texts:
            packed, decoded, stream = bytearray(), hashlib.sha256(), Utf8Stream()
            for block in machine.encode(t):
                packed += block
                for piece in machine.pieces(block):
                    decoded.update(stream.feed(piece).encode())
            decoded.update(stream.end().encode())
            out["n_tokens"].append(len(packed) // 4)
            out["ids"].append(bytes(packed))
            out["decoded_sha256"].append(decoded.hexdigest())
        return out

    return map_texts(df, keys, text, rows, "n_tokens long, ids binary, decoded_sha256 string", lambda: here().empty())


def round_trip(df: DataFrame, ranks_path: str, pattern: str, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: each whole
    text is encoded, its ids decoded as a stream, and both digested."""
    here = shared(df.sparkSession, ranks_path, pattern)

    def rows(texts: list[str]) -> dict[str, list]:
        machine = here()
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for t in texts:
            ids, decoded, stream, n = hashlib.sha256(), hashlib.sha256(), Utf8Stream(), 0
            for block in machine.encode(t):
                n += len(block) // 4
                ids.update(block)
                for piece in machine.pieces(block):
                    decoded.update(stream.feed(piece).encode())
            decoded.update(stream.end().encode())
            out["n_tokens"].append(n)
            out["ids_sha256"].append(ids.hexdigest())
            out["decoded_sha256"].append(decoded.hexdigest())
        return out

    return map_texts(df, keys, text, rows, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda: here().empty())
