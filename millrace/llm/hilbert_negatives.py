"""Hard negatives: rows of another label that score a little below an anchor's positives.

Vectors are scaled to integers (``floor(SCALE * x)``), given a place on a Hilbert
curve (two bits a dimension: side of zero, and beyond the vector's mean size or
not), put in that order by ranges, and written as Parquet blocks of ``BLOCK`` rows, each
with the least and greatest value of every dimension (its zone map). An
anchor's inner product with any row of a block lies between sums of the smaller
and the greater products with these ends. A block is scored for an anchor
only if those bounds meet one of the anchor's windows above what its best rows have
reached by then. First the window is all scores of the same label (the best
are positives; the anchor's own block gives a first floor); then there is one window
below each positive, over the other labels. Bounds and scores are exact in
floating point as long as no product of two lengths reaches 2^53; beyond it
Python's integers are used.

Anchors come in chunks of ``CHUNK_BYTES``, broadcast one at a time, and all blocks
are met with each: a stated query set against all rows. A task keeps the best
rows per anchor over its blocks, so what is shuffled are some rows per anchor and task. Every
chunk's rows are written to the shared folder before the next one starts.

Defined results: rows with a null id, label or vector, or a null or non-finite component,
take no part; shorter vectors are filled with zeros; of equal scores the
smaller id comes first; rows of an anchor's own id are no positives of it, other repeated
rows count each; an anchor without positives or without rows in a window has
none; an empty table gives an empty result; other columns are dropped and may
have any name. Scores must fit 64 bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import materialize, shared_folder

SCALE = 256
BLOCK = 512  # rows
PART = 8 * BLOCK  # rows of a range, as long as ranges are few
CHUNK_BYTES = 16 << 20  # of anchors in one broadcast
SLICE = 4096  # anchors scored against a block at once
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a window, in hundredths of the positive's score
BLOCKS = "lo array<double>, hi array<double>, ids array<long>, labels array<long>, chosen array<boolean>, flat array<double>"
NONE = np.iinfo(np.int64).max  # the id of an empty place


def hilbert_keys(cells: np.ndarray, bits: int = 2) -> np.ndarray:
    """Places on the Hilbert curve through a grid of 2^bits cells a dimension, as rows of bytes.

    The axes are turned level by level from the coarsest bit down (inverse of
    exchanging and inverting the lower bits), then Gray-decoded and interleaved.
    """
    x = cells.astype(np.uint8).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint8(1 << level), np.uint8((1 << level) - 1)
        for d in range(dims):
            inverts = (x[d] & bit) != 0
            swapped = np.where(inverts, 0, (x[0] ^ x[d]) & below).astype(np.uint8)
            x[0] ^= np.where(inverts, below, swapped)
            x[d] ^= swapped
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flips = np.zeros(x.shape[1], np.uint8)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] & np.uint8(1 << level), np.uint8((1 << level) - 1), np.uint8(0))
    x ^= flips
    planes = [(x >> np.uint8(level)) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def cells_of(vectors: np.ndarray) -> np.ndarray:
    size = np.abs(vectors).mean(axis=1, keepdims=True)
    return (vectors >= -size).astype(np.uint8) + (vectors >= 0) + (vectors >= size)


def write_blocks(rows: DataFrame, chosen: Column, path: str) -> int:
    """Blocks of ``rows`` (``vec_id``, ``label``, ``embedding``) in Hilbert order; the vectors' length."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is greater than all
    usable = rows.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.coalesce(chosen, F.lit(False)).alias("chosen"), vector.alias("v")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    width = usable.agg(F.max(F.size("v"))).first()[0]
    if not width:
        width = 1
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = hilbert_keys(cells_of(matrix(batch.column(3), width)))
            made = pa.array([k.tobytes() for k in keys], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], ["vec_id", "label", "chosen", "v", "key"])

    placed = materialize(usable.withColumn("v", filled).mapInArrow(keyed, "vec_id long, label long, chosen boolean, v array<double>, key binary"))
    parts = min(1 + placed.count() // PART, 32 * rows.sparkSession.sparkContext.defaultParallelism)
    ordered = placed.repartitionByRange(parts, "key", "vec_id").sortWithinPartitions("key", "vec_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = np.floor(SCALE * matrix(batch.column(3), width))
            for lo in range(0, batch.num_rows, BLOCK):
                some, own = batch.slice(lo, BLOCK), scaled[lo : lo + BLOCK]
                yield pa.RecordBatch.from_pydict({
                    "lo": [own.min(axis=0)], "hi": [own.max(axis=0)],
                    **{name: pa.array([some.column(i).to_pylist()]) for i, name in enumerate(("ids", "labels", "chosen"))},
                    "flat": [own.ravel()],
                })

    ordered.select("vec_id", "label", "chosen", "v").mapInArrow(pack, BLOCKS).write.parquet(path)
    return width


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products: rows of ``left`` with rows of ``right``."""
    lengths = [np.sqrt((m * m).sum(axis=1).max(initial=0)) for m in (left, right)]
    most = lengths[0] * lengths[1] * 1.001
    if most < 1 << 24:
        return left.astype(np.float32) @ right.astype(np.float32).T
    if most < 1 << 53:
        return left @ right.T
    left, right = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (left, right))
    return (left @ right.T).astype(np.int64)


class Best:
    """The best ``most`` rows of each window of each anchor, by score and then id."""

    def __init__(self, floor: np.ndarray, ceiling: np.ndarray, most: int) -> None:
        self.floor, self.ceiling = floor.copy(), ceiling  # by anchor and window
        self.score = np.full((*floor.shape, most), np.iinfo(np.int64).min)
        self.ids = np.full((*floor.shape, most), NONE)

    def wants(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Anchors for which scores from ``low`` to ``high`` may matter."""
        return ((high[:, None] >= self.floor) & (low[:, None] <= self.ceiling)).any(axis=1)

    def offer(self, of: np.ndarray, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some rows (``ids``) with the anchors numbered ``of``, where ``fits``."""
        most = self.score.shape[2]
        open_ = self.floor[of] <= self.ceiling[of]
        least = np.where(open_, self.floor[of], np.iinfo(np.int64).max).min(axis=1)
        greatest = np.where(open_, self.ceiling[of], np.iinfo(np.int64).min).max(axis=1)
        at, column = np.nonzero((scores >= least[:, None]) & (scores <= greatest[:, None]) & fits)
        value, name, anchor = scores[at, column].astype(np.int64), ids[column], of[at]
        for w in range(self.floor.shape[1]):
            in_window = (value >= self.floor[anchor, w]) & (value <= self.ceiling[anchor, w])
            who = np.unique(anchor[in_window])
            if not len(who):
                continue
            owner = np.concatenate([anchor[in_window], np.repeat(who, most)])
            score = np.concatenate([value[in_window], self.score[who, w].ravel()])
            ident = np.concatenate([name[in_window], self.ids[who, w].ravel()])
            order = np.lexsort((ident, ~score, owner))  # ~ turns the order and cannot overflow
            owner, score, ident = owner[order], score[order], ident[order]
            first = np.searchsorted(owner, who)
            places = first[:, None] + np.arange(most)
            self.score[who, w], self.ids[who, w] = score[places], ident[places]
            full = self.ids[who, w, most - 1] != NONE
            self.floor[who[full], w] = np.maximum(self.floor[who[full], w], self.score[who[full], w, most - 1])


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product of each anchor with any vector between ``lo`` and ``hi``."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ lo + down @ hi, up @ hi + down @ lo


def search(blocks: DataFrame, anchors: dict, floor: np.ndarray, ceiling: np.ndarray, same: bool, most: int) -> DataFrame:
    """``anchor`` and ``window`` numbers, ``score``, ``vec_id`` and ``rank`` of the best rows of the same or another label."""
    sent = blocks.sparkSession.sparkContext.broadcast((anchors, floor, ceiling))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, floor, ceiling = sent.value
        best, lengths = Best(floor, ceiling, most), np.linalg.norm(own["vectors"], axis=1)
        for batch in batches:
            for i in range(batch.num_rows):
                lo, hi, ids, labels, flat = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(5))
                rows = flat.reshape(len(ids), -1)
                low, high = bounds(own["vectors"], lo, hi)
                wide = 1 + 1e-12 * lengths * np.linalg.norm(np.maximum(np.abs(lo), np.abs(hi)))  # beyond any rounding
                chosen = np.flatnonzero(best.wants(low - wide, high + wide))
                for a, b in pairwise([*range(0, len(chosen), SLICE), len(chosen)]):
                    of = chosen[a:b]
                    fits = (own["labels"][of][:, None] == labels) == same
                    if same:
                        fits &= own["ids"][of][:, None] != ids
                    best.offer(of, products(own["vectors"][of], rows), fits, ids)
        anchor, window, place = np.nonzero(best.ids != NONE)
        yield pa.RecordBatch.from_pydict({
            "anchor": anchor, "window": window, "score": best.score[anchor, window, place], "vec_id": best.ids[anchor, window, place],
        })

    found = blocks.select("lo", "hi", "ids", "labels", "flat").mapInArrow(run, "anchor long, window long, score long, vec_id long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def anchors_of(blocks: DataFrame, positives: int) -> DataFrame:
    """Chosen rows, each with the least score of the best ``positives`` in its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, chosen, flat = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(4))
                rows, own = flat.reshape(len(ids), -1), np.flatnonzero(chosen)
                if not len(own):
                    continue
                scores = products(rows[own], rows)
                fits = (labels[own][:, None] == labels) & (ids[own][:, None] != ids)
                floors = [
                    int(np.sort(s[f])[-positives]) if f.sum() >= positives else np.iinfo(np.int64).min for s, f in zip(scores, fits)
                ]
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids[own], "label": labels[own], "floor": np.array(floors, np.int64), "v": list(rows[own]),
                })

    return blocks.select("ids", "labels", "chosen", "flat").mapInArrow(run, "vec_id long, label long, floor long, v array<double>")


def mine(
    rows: DataFrame, chosen: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Hard negatives of the ``chosen`` rows: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    width = write_blocks(rows, chosen, f"{folder}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    anchors = materialize(anchors_of(blocks, positives))
    chunks = 1 + anchors.count() * width * 8 // chunk_bytes
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.lit(chunks)))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/found/chunk=-1")
    for chunk in range(chunks):
        some = anchors.where(F.col("chunk") == chunk).toArrow().combine_chunks()
        if not len(some):
            continue
        own = {
            "ids": some["vec_id"].to_numpy(), "labels": some["label"].to_numpy(),
            "vectors": some["v"].combine_chunks().flatten().to_numpy().reshape(len(some), width),
        }
        floor = some["floor"].to_numpy()[:, None]
        best = search(blocks, own, floor, np.full_like(floor, np.iinfo(np.int64).max), True, positives).toArrow()
        anchor, place = best["anchor"].to_numpy(), best["rank"].to_numpy() - 1
        score, ident = best["score"].to_numpy(), best["vec_id"].to_numpy()
        floors = np.full((len(some), positives), 1)  # no window where there is no positive
        ceilings = np.zeros_like(floors)
        floors[anchor, place] = [-(-low * int(s) // 100) for s in score]
        ceilings[anchor, place] = [high * int(s) // 100 for s in score]
        pairs = spark.createDataFrame(pa.table({
            "anchor": anchor, "window": place.astype(np.int64), "anchor_id": own["ids"][anchor], "positive_id": ident, "positive_score": score,
        }))
        found = search(blocks, own, floors, ceilings, False, negatives)
        found.join(pairs, ["anchor", "window"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.parquet(f"{folder}/found/chunk={chunk}")
    return spark.read.schema(schema).parquet(f"{folder}/found").drop("chunk")
