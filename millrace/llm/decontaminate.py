"""Benchmark decontamination: windows of test words, looked up in training texts.

Texts are lower-cased (A-Z) and cut into words, which are kept with one blank
between them. A *window* is ``LENGTH`` consecutive words of a benchmark item; an
item with fewer words, but not none, is one window. The hashes of all windows
are broadcast as a sorted array, besides the benchmark's own words. Each
training text is scanned where it was read: a rolling hash gives every window
of its words at once, those found in the set are verified word for word, and
every word inside a verified window is *hit*. Spans of hit words, or documents
that hold any, can be removed.

The broadcast is bounded: items go to blocks of ``MOST_BYTES`` of text, and the
texts are scanned once per block, with a checkpoint between blocks, so a worker
never holds more than one. Nothing is shuffled.

Defined results: a null text has no words; a null item id is written as the
empty string; items that repeat count once per id; an item without words has
no window; an empty benchmark hits nothing; an empty table gives an empty
result; repeated rows are scanned each; columns of any name pass through, as
they travel inside one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.texts import SLICE, whole_text
from millrace.session import materialize

LENGTH = 10
MOST_BYTES = 32 << 20  # of benchmark text in one broadcast
FINE = 256  # blocks are packed from so many parts per broadcast
BLANK = 0x20
# The byte a word keeps of each byte read: digits, a-z (A-Z lower-cased) and all of UTF-8 beyond ASCII; else a blank.
LOWER = np.array([b | 0x20 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else BLANK for b in range(256)], np.uint8)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
STEP = 1 << 16
RUNS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))


def powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^(STEP * i) modulo 2^64."""
    out = []
    for each in (1, STEP):
        factors = np.full(STEP, pow(base, each, 1 << 64), np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


UP, DOWN = powers(BASE), powers(pow(BASE, -1, 1 << 64))


class Words:
    """The words of texts: ``text`` holds them with a blank after each; ``start``
    and ``end`` are their places there, ``raw_start`` and ``raw_end`` those in
    the texts joined by a zero byte, ``of`` is the number of the text of each."""

    def __init__(self, texts: list[bytes]) -> None:
        raw = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        low = LOWER[raw]
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = low != BLANK
        edges = np.flatnonzero(np.diff(inside))
        self.raw_start, self.raw_end = edges[::2], edges[1::2]
        keep = inside[1:-1].astype(bool)
        keep[self.raw_end] = True  # each text ends with a zero byte
        self.text = low[keep]
        lengths = self.raw_end - self.raw_start
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.begins = begins
        self.of = np.searchsorted(begins, self.raw_start, "right") - 1

    def __len__(self) -> int:
        return len(self.start)

    @cached_property
    def content(self) -> bytes:
        return self.text.tobytes()

    @cached_property
    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Sums of byte * BASE^place before each word's start and end, modulo 2^64."""
        at = np.stack([self.start, self.end], 1).ravel()
        out, carry = np.zeros(len(at), np.uint64), np.uint64(0)
        cuts = np.searchsorted(at, np.arange(0, len(self.text) + STEP, STEP), "right")
        for number, lo in enumerate(range(0, len(self.text), STEP)):
            some = self.text[lo : lo + STEP].astype(np.uint64)
            run = np.cumsum(some * UP[0][: len(some)] * UP[1][number], dtype=np.uint64) + carry
            here = slice(cuts[number], cuts[number + 1])  # places in (lo, lo + STEP]
            out[here] = run[at[here] - lo - 1]
            carry = run[-1]
        return out[::2], out[1::2]

    def hashes(self, length: int) -> np.ndarray:
        """A hash of each run of ``length`` words, by its first word."""
        n = max(0, len(self) - length + 1)
        before, through = self.sums
        start = self.start[:n]
        found = (through[length - 1 :][:n] - before[:n]) * DOWN[0][start % STEP] * DOWN[1][start // STEP]
        return (found ^ (found >> np.uint64(29))) * np.uint64(BASE)

    def whole(self, length: int) -> np.ndarray:
        """Which of these runs lie in one text."""
        n = max(0, len(self) - length + 1)
        return self.of[:n] == self.of[length - 1 :][:n]

    def run(self, first: int, length: int) -> bytes:
        return self.content[self.start[first] : self.end[first + length - 1]]


@dataclass(frozen=True)
class Windows:
    """A block of the benchmark: its words, their items, and for each window
    length the sorted hashes, their first words, and a bitmap of the hashes' top bits."""

    content: bytes
    start: np.ndarray
    end: np.ndarray
    item_of: np.ndarray
    items: list[str]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(ids: list[str], texts: list[str]) -> Windows:
        words = Words([t.encode() for t in texts])
        count = np.bincount(words.of, minlength=len(texts))
        by_length = {}
        for length in sorted({min(LENGTH, int(n)) for n in count if n}):
            first = np.flatnonzero(words.whole(length))
            if length < LENGTH:  # only items of just so many words
                first = first[count[words.of[first]] == length]
            own = words.hashes(length)[first]
            order = np.argsort(own, kind="stable")
            bits = np.zeros(1 << 22, bool)
            bits[own >> np.uint64(42)] = True
            by_length[length] = own[order], first[order], bits
        return Windows(words.content, words.start, words.end, words.of, ids, by_length)

    def verified(self, length: int, content: bytes, place: int) -> list[str]:
        """The items that hold a run of words, among the windows of one hash, from ``place`` on."""
        hashes, first, _ = self.by_length[length]
        found = set()
        for at in first[place : np.searchsorted(hashes, hashes[place], "right")]:
            if self.content[self.start[at] : self.end[at + length - 1]] == content:
                found.add(self.items[self.item_of[at]])
        return sorted(found)


def scan_texts(texts: list[bytes], windows: Windows) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """For each text its number of words, its runs of hit words, and the items found."""
    words = Words(texts)
    count = np.bincount(words.of, minlength=len(texts))
    change = np.zeros(len(words) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for length, (hashes, _, bits) in windows.by_length.items():
        own = words.hashes(length)
        maybe = np.flatnonzero(bits[own >> np.uint64(42)] & words.whole(length))
        place = np.searchsorted(hashes, own[maybe])
        place[place == len(hashes)] = 0
        same = hashes[place] == own[maybe]
        known: dict[bytes, list[str]] = {}
        for first, at in zip(maybe[same].tolist(), place[same].tolist()):
            content = words.run(first, length)
            if content not in known:
                known[content] = windows.verified(length, content, at)
            if known[content]:
                change[first] += 1
                change[first + length] -= 1
                items[words.of[first]].update(known[content])
    hit = np.zeros(len(words) + 2, np.int8)
    hit[1:-1] = np.cumsum(change[:-1]) > 0
    # a run ends with its text
    inner = np.flatnonzero(np.diff(words.of)) + 1
    runs: list[list[tuple[int, int]]] = [[] for _ in texts]
    begins = np.concatenate([[0], np.cumsum(count)])
    edges = np.flatnonzero(np.diff(hit))
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
        cuts = inner[np.searchsorted(inner, lo, "right") : np.searchsorted(inner, hi, "left")].tolist()
        for a, b in pairwise([lo, *cuts, hi]):
            text = int(words.of[a])
            runs[text].append((a - int(begins[text]), b - int(begins[text])))
    return count, runs, items


def union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def cut(text: str, runs: list[tuple[int, int]]) -> str:
    """A text without the given runs of words."""
    if not runs:
        return text
    raw = text.encode()
    words = Words([raw])
    bounds = [0, *(int(b) for lo, hi in runs for b in (words.raw_start[lo], words.raw_end[hi - 1])), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])).decode()


def blocks(benchmark: DataFrame, key: str, text: str, most_bytes: int) -> Iterator[Windows]:
    """The benchmark's windows, in blocks of about ``most_bytes`` of text. Only one is on the driver at a time."""
    items = benchmark.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), whole_text(text).alias("text")
    ).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if not total:
        return
    parts = FINE * (1 + total // most_bytes)
    items = items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)))
    sizes = items.groupBy("part").agg(F.sum(F.octet_length("text")).alias("n")).orderBy("part").collect()
    held, ends = 0, [-1]
    for r in sizes:
        if held and held + r.n > most_bytes:
            ends.append(r.part - 1)
            held = 0
        held += r.n
    for lo, hi in pairwise([*ends, parts]):
        some = items.where(F.col("part").between(lo + 1, hi)).select("id", "text").toArrow()
        yield Windows.of(some["id"].to_pylist(), some["text"].to_pylist())


def over_texts(rows: DataFrame, fields: list[T.StructField], make) -> DataFrame:
    """``rows`` (``row``, ``text``, then what has been found so far) with new
    columns in place of the last ones; ``make`` gets slices of texts and those columns."""
    kept = [rows.schema["row"], rows.schema["text"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = np.cumsum(pc.binary_length(batch.column(1)).to_numpy()) // SLICE
            for lo, hi in pairwise([0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]):
                some = batch.slice(lo, hi - lo)
                found = make([t.encode() for t in some.column(1).to_pylist()], [c.to_pylist() for c in some.columns[2:]])
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *found], [f.name for f in (*kept, *fields)])

    return rows.mapInArrow(run, T.StructType([*kept, *fields]))


FOUND = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("items", T.ArrayType(T.StringType()))]
RUNS_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``row`` (the document), ``text``, ``n_words``, ``runs`` (of hit words: number
    of the first word and of the one after the last) and ``items`` (ids as strings)."""
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), whole_text(text).alias("text"))
    done = None
    for windows in _first_or_none(blocks(benchmark, item, item_text, most_bytes)):
        sent = spark.sparkContext.broadcast(windows)

        def make(texts: list[bytes], before: list[list], sent=sent) -> list[pa.Array]:
            count, runs, items = scan_texts(texts, sent.value)
            if before:
                runs = [union([*own, *((r["first"], r["end"]) for r in old)]) for own, old in zip(runs, before[1])]
                items = [own | set(old) for own, old in zip(items, before[2])]
            return [
                pa.array(count, pa.int64()),
                pa.array([[{"first": a, "end": b} for a, b in r] for r in runs], RUNS_ARROW),
                pa.array([sorted(i) for i in items], pa.list_(pa.string())),
            ]

        done = over_texts(rows if done is None else materialize(done), FOUND, make)
    return done


def _first_or_none(found: Iterator[Windows]) -> Iterator[Windows]:
    """The blocks, or an empty one where there is none, so that words are counted."""
    first = next(found, None)
    yield Windows.of([], []) if first is None else first
    yield from found


def remove_documents(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """Documents without any hit word."""
    return scan(docs, benchmark, **names).where(F.size("runs") == 0).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """All documents; runs of hit words, with what stands between their words, are cut out of their texts.
    Texts without a hit stay as they are, null ones too."""

    @F.udf("string", useArrow=True)
    def without(whole: str, runs: list) -> str:
        return cut(whole, [(r["first"], r["end"]) for r in runs])

    found = scan(docs, benchmark, text, **names)
    own = F.when(F.size("runs") == 0, F.col("row").getField(text)).otherwise(without("text", "runs"))
    return found.select(*(own.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))
