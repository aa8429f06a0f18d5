"""Document fingerprints as a homomorphic multiset hash of paragraphs.

Each paragraph (line) is hashed to a wide vector, and a document's fingerprint
is the sum of its paragraphs' vectors, lane by lane: ``EQUAL`` lanes modulo
2^32 from an extendable-output hash of the paragraph, and ``LIKE`` lanes
modulo 2^32 to which each run of three words adds one or minus one in a lane
of its own. The sum does not depend on the order of paragraphs, and inserting
or deleting a paragraph adds or subtracts its vector. The first lanes answer
equality; the cosine of the second lanes estimates the share of word runs that
two documents have in common.

The next document in ascending id is found without a whole-table window: ids
are cut into ranges, each range is sorted in one partition, and the first row
of each range is also sent to the range before it.

Defined results: a null text is the empty text, one empty paragraph; ids that
are null come first, equal ids are ordered by text; a single document is its
own next; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import whole_text

EQUAL, LIKE = 64, 256
RUN = 3


class Hasher:
    """Vectors of lists of paragraphs; remembers the hashes of ``remembered`` words at most."""

    def __init__(self, remembered: int = 200_000) -> None:
        self.known: dict[bytes, int] = {}
        self.remembered = remembered

    def words(self, paragraphs: list[bytes]) -> np.ndarray:
        """Hashes of all words, two zeros after each paragraph."""
        if len(self.known) > self.remembered:
            self.known.clear()
        known, out = self.known, []
        for paragraph in paragraphs:
            for word in paragraph.split():
                value = known.get(word)
                if value is None:
                    value = known[word] = xxhash.xxh64_intdigest(word) | 1
                out.append(value)
            out += (0, 0)
        return np.array(out, np.uint64)

    def vector(self, paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the vectors of ``paragraphs``."""
        data = [p.encode() for p in paragraphs]
        wide = b"".join([hashlib.shake_128(p).digest(4 * EQUAL) for p in data])
        equal = np.frombuffer(wide, "<u4").reshape(-1, EQUAL).sum(0, dtype=np.uint32)
        words = self.words(data)
        first = words[:-2] if len(words) else words
        mixed = first * np.uint64(0x9E3779B97F4A7C15)
        for i in range(1, RUN):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[i : len(words) - 2 + i]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        mixed = mixed[first != 0]
        lane = (mixed >> np.uint64(56)).astype(np.int64) % LIKE
        sign = 1.0 - 2.0 * ((mixed >> np.uint64(55)) & np.uint64(1)).astype(float)
        like = np.bincount(lane, sign, LIKE).astype(np.int64).astype(np.uint32)
        return equal, like


def add(a, b):
    return a[0] + b[0], a[1] + b[1]


def subtract(a, b):
    return a[0] - b[0], a[1] - b[1]


def packed(vector) -> str:
    return base64.b64encode(vector[0].tobytes() + vector[1].tobytes()).decode()


def unpacked(fingerprint: str):
    data = base64.b64decode(fingerprint)
    return np.frombuffer(data, "<u4", EQUAL), np.frombuffer(data, "<u4", LIKE, 4 * EQUAL)


def fingerprint(text: str, hasher: Hasher | None = None) -> str:
    return packed((hasher or Hasher()).vector(text.split("\n")))


def likeness(a, b) -> float:
    """1 for equal multisets; else the cosine of the like lanes, 0 at least."""
    if np.array_equal(a[0], b[0]):
        return 1.0
    x, y = a[1].view(np.int32).astype(float), b[1].view(np.int32).astype(float)
    size = float(np.sqrt((x @ x) * (y @ y)))
    return min(1.0, max(0.0, float(x @ y) / size)) if size else 0.0


def range_of(key: Column, bounds: list, kind: str) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``; looks at about twice their root."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.size(F.filter(F.lit(bounds[step - 1 :: step]).cast(f"array<{kind}>"), lambda b: b <= key))
    fine = F.size(F.filter(F.slice(F.lit(bounds).cast(f"array<{kind}>"), coarse * step + 1, F.lit(step)), lambda b: b <= key))
    return F.when(key.isNull(), 0).otherwise(coarse * step + fine)


def with_next(docs: DataFrame, key: str, text: str, ranges: int) -> DataFrame:
    """``_range``, ``_guest``, ``_id`` and ``_text``, one range after the other
    in each partition, sorted; a guest is the row after the range's last."""
    narrow = docs.select(F.col(key).alias("_id"), whole_text(text).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    marks = [i / ranges for i in range(1, ranges)]
    quantiles = narrow.agg(F.percentile_approx("_id", F.lit(marks), F.lit(20 * ranges)).alias("q")).first().q if marks else []
    ranged = narrow.select(range_of(F.col("_id"), sorted(set(quantiles or [])), kind).alias("_range"), F.lit(False).alias("_guest"), "_id", "_text")
    # One row per range: which ranges have rows, and which is before which.
    first = ranged.groupBy("_range").agg(F.min(F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"))).alias("f")).collect()
    order = sorted(r["_range"] for r in first)
    if not order:
        return ranged
    before = {r: order[i - 1] for i, r in enumerate(order)}
    heads = docs.sparkSession.createDataFrame(
        [(r["_range"], before[r["_range"]], r["f"]["id"]) for r in first], f"_range int, _before int, _first {kind}"
    )
    guests = (
        narrow.join(F.broadcast(heads), F.col("_id").eqNullSafe(F.col("_first")))
        .groupBy("_range", "_before", "_id").agg(F.min("_text").alias("_text"))
        .select(F.col("_before").alias("_range"), F.lit(True).alias("_guest"), "_id", "_text")
    )
    both = ranged.unionByName(guests)
    return both.repartitionById(ranges, F.col("_range")).sortWithinPartitions("_range", "_guest", "_id", "_text")


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next of each document. The edited text's fingerprint
    is the text's, less the paragraphs that end in the replaced part, plus the
    new ones."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs, key, text, ranges)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last = Hasher(), None
        for batch in batches:
            out: list[tuple] = []
            for part, guest, own, body in zip(*(c.to_pylist() for c in batch.columns)):
                if guest:  # only closes the range before
                    if last and last[0] == part:
                        out.append(edited(last, body, vectors(hasher, body)[0], hasher))
                    last = None
                    continue
                whole = vectors(hasher, body)
                if last:
                    out.append(edited(last, body, whole[0], hasher))
                last = (part, own, body, *whole)
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.column(2).type), *(pa.array(c) for c in columns[1:])],
                    names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return rows.mapInArrow(
        run, f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )


def replaced(text: str) -> int:
    return len(text) // 4


def vectors(hasher: Hasher, text: str):
    """The text's vector, that of the paragraphs from the one on in which the
    replaced part begins, and where that paragraph begins."""
    begin = text.rfind("\n", 0, len(text) - replaced(text)) + 1
    rest = hasher.vector(text[begin:].split("\n"))
    whole = add(hasher.vector(text[:begin].split("\n")[:-1]), rest) if begin else rest
    return whole, rest, begin


def edited(last: tuple, after: str, after_vector, hasher: Hasher) -> tuple:
    _, own, text, whole, rest, begin = last
    cut = replaced(text)
    new = text[begin : len(text) - cut] + after[:cut]
    changed = add(subtract(whole, rest), hasher.vector(new.split("\n")))
    digest = hashlib.sha256((text[:begin] + new).encode()).hexdigest()
    return own, len(text), digest, packed(whole), packed(changed), likeness(whole, changed), likeness(whole, after_vector)
