"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at ``THRESHOLD`` = 4 or fewer differing bits.
They are cut into three segments of 22, 21 and 21 bits, so of any linked pair
some segment differs in at most one bit. In each segment the anchors are the
4,096 codewords of the binary Golay code of length 23, whose covering radius
is 3: every fingerprint has one *home* anchor within 3 bits, and is copied as
a *guest* to all anchors within 3 + 1 bits (5.3 on average). A linked pair
then meets at the home anchor of either of them. Per anchor, homes are
compared with guests on all 64 bits.

Copies are no burden: equal fingerprints become one row first, and of the
links found at an anchor only a spanning forest leaves the task. An anchor
with more members than ``HOMES`` or ``GUESTS`` is dealt to a grid of tasks,
each home chunk against each guest chunk, so no pair is lost and no task gets
more. Components are then found by large-star and small-star rounds on tables.

Defined results: null and blank texts have fingerprint zero and link like any
other; a null id is never the smallest unless all are null; an empty table
gives an empty result; repeated rows share a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import map_texts
from millrace.session import materialize

THRESHOLD = 4
SEED = 42
SHINGLE = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
LENGTH, RADIUS = 23, 3
GENERATOR = 0b101011100011  # of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
HOMES, GUESTS = 1 << 14, 1 << 17


def fingerprint(text: str, size: int = SHINGLE, block: int = 1 << 17) -> int:
    """The SimHash of the shingles of a text, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    digest, join, total = xxhash.xxh64_digest, b" ".join, len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, block):
        part = words[at : at + block + size - 1]
        hashed = b"".join([digest(join(s), SEED) for s in zip(*(part[i:] for i in range(size)))])
        ones += np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8)[:, ::-1], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fp``, the fingerprint as a signed 64-bit integer."""

    def rows(texts: list[str]) -> dict[str, list]:
        return {"fp": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)}

    return map_texts(docs, keys, text, rows, "fp long")


class Golay:
    """Anchors near a 23-bit word, by its syndrome."""

    def __init__(self) -> None:
        single = np.array([self.remainder(1 << i) for i in range(LENGTH)], np.int64)
        near: list[list[int]] = [[] for _ in range(1 << 11)]
        for weight in range(RADIUS + 2):
            for bits in combinations(range(LENGTH), weight):
                near[int(np.bitwise_xor.reduce(single[list(bits)])) if bits else 0].append(sum(1 << b for b in bits))
        self.single = single
        self.home = np.array([e[0] for e in near], np.int64)
        most = max(map(len, near))
        self.around = np.array([e + [-1] * (most - len(e)) for e in near], np.int64)  # -1: no more

    @staticmethod
    def remainder(word: int) -> int:
        for bit in range(LENGTH - 1, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << bit - 11
        return word

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for bit in range(LENGTH):
            out ^= np.where(words >> bit & 1, self.single[bit], 0)
        return out


_golay: list[Golay] = []


def replicas(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor key, fingerprint and whether it is at home there, for all segments."""
    if not _golay:
        _golay.append(Golay())
    code, keys, rows, homes = _golay[0], [], [], []
    unsigned = fps.view(np.uint64)
    for number, (first, bits) in enumerate(SEGMENTS):
        words = (unsigned >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)
        syndrome = code.syndrome(words)
        errors = code.around[syndrome]
        used = errors >= 0
        anchors = (words[:, None] ^ errors)[used]
        who = np.broadcast_to(np.arange(len(fps))[:, None], errors.shape)[used]
        keys.append(anchors | number << LENGTH)
        rows.append(who)
        homes.append(anchors == (words ^ code.home[syndrome])[who])
    return np.concatenate(keys), fps[np.concatenate(rows)], np.concatenate(homes)


def forest(fps: np.ndarray, home: np.ndarray, threshold: int, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep connected what is linked among one anchor's members."""
    fps, first = np.unique(fps, return_inverse=True)
    at_home = np.zeros(len(fps), bool)
    at_home[first[home]] = True
    homes, label = np.flatnonzero(at_home), np.arange(len(fps))
    bits = fps.view(np.uint64)
    left: list[int] = []
    right: list[int] = []
    step = max(1, block // max(1, len(fps)))
    for at in range(0, len(homes), step):
        some = homes[at : at + step]
        near = np.bitwise_count(bits[some][:, None] ^ bits[None, :]) <= threshold
        for own in np.flatnonzero(near.sum(1) > near[np.arange(len(some)), some]):
            found = np.flatnonzero(near[own])
            labels, one = np.unique(np.append(label[found], label[some[own]]), return_index=True)
            if len(labels) > 1:
                members = np.append(found, some[own])[one]
                members = members[label[members] != label[some[own]]]
                left += [some[own]] * len(members)
                right += members.tolist()
                label[np.isin(label, labels)] = labels[0]
    return fps[left], fps[right]


def links(fps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``fps`` that connect
    all that are ``threshold`` or fewer bits apart, and none that are not."""
    if not 0 <= threshold <= 5:  # three segments: one has threshold // 3 <= 1 differing bits
        raise ValueError("the covering holds for thresholds up to 5")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp, home = replicas(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_pydict({"key": pa.array(key, pa.int32()), "fp": fp, "home": home})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, home in by_key(batches):
            a, b = forest(fp, home, threshold)
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    members = fps.mapInArrow(spread, "key int, fp long, home boolean")
    counted = members.groupBy("key").agg(F.count_if("home").alias("h"), F.count(F.lit(1)).alias("g"))
    # At most 3 x 4,096 anchors, so this table is bounded whatever the input.
    grid = F.broadcast(counted.select("key", (F.col("h") / HOMES).cast("int").alias("h"), (F.col("g") / GUESTS).cast("int").alias("g")))
    own, width = F.pmod(F.xxhash64("fp"), F.col("h") + 1).cast("int"), F.col("g") + 1
    other = F.pmod(F.xxhash64("fp", F.lit(1)), width).cast("int")
    at_home = F.transform(F.sequence(F.lit(0), F.col("g")), lambda j: F.struct((own * width + j).alias("cell"), F.lit(True).alias("home")))
    as_guest = F.transform(F.sequence(F.lit(0), F.col("h")), lambda i: F.struct((i * width + other).alias("cell"), F.lit(False).alias("home")))
    not_own = F.filter(as_guest, lambda c: (c["cell"] / width).cast("int") != own)
    cells = F.when(F.col("home"), F.concat(at_home, not_own)).otherwise(as_guest)
    dealt = members.join(grid, "key").select("key", "fp", F.explode(cells).alias("c")).select("key", "c.cell", "fp", "c.home")
    return (
        dealt.repartition("key", "cell").sortWithinPartitions("key", "cell").mapInArrow(compare, "a long, b long").distinct()
    )


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The members of one (key, cell) after the other; rows come sorted by both."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
        fp, home = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
        begins = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        for lo, hi in zip(begins[:-1], begins[1:]):
            if held and key[lo] != last:
                yield last, np.concatenate([f for f, _ in held]), np.concatenate([h for _, h in held])
                held = []
            last = key[lo]
            held.append((fp[lo:hi], home[lo:hi]))
    if held:
        yield last, np.concatenate([f for f, _ in held]), np.concatenate([h for _, h in held])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, of every
    node in ``edges`` (a, b). Rounds of large-star and small-star, each written
    to the checkpoint folder, until a round changes nothing."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e"))
        edges = materialize(small.select("e.a", "e.b").where("a != b").distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def labelled(of_docs: DataFrame, low: Column, threshold: int) -> DataFrame:
    """``fp`` and ``low``, the smallest ``low`` of all documents of its component."""
    distinct = of_docs.groupBy("fp").agg(F.min(low).alias("low"))
    found = components(links(distinct.select("fp"), threshold))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("low"))
    return rooted.select("fp", "root").join(lowest, "root").select("fp", "low")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: ``key``, ``fp`` and ``component_id``, the smallest
    ``key`` that can be reached over links."""
    of_docs = materialize(fingerprints(docs, [key], text))
    return of_docs.join(labelled(of_docs, F.col(key), threshold), "fp").select(key, "fp", F.col("low").alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The whole rows of ``docs`` whose ``key`` is the smallest of their
    component; of equal keys the one with the smallest text hash. Rows that
    repeat key and text are one document and stay together."""
    mark = F.xxhash64(F.col(text))
    of_docs = materialize(fingerprints(docs.select(F.col(key).alias("_key"), mark.alias("_mark"), F.col(text)), ["_key", "_mark"], text))
    own = F.struct("_key", "_mark")
    dropped = of_docs.join(labelled(of_docs, own, threshold), "fp").where(~own.eqNullSafe(F.col("low"))).select("_key", "_mark")
    return docs.join(dropped, F.col(key).eqNullSafe(F.col("_key")) & (mark == F.col("_mark")), "left_anti")
