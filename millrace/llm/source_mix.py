"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. *Targets*: sources share the words of all of them by weight; none takes
   more than ``REPEATS`` times its words, and what is over goes to the others.
2. *Blocks*: a hash of the id puts each document at a fixed random place of
   its source, and places are cut into blocks of about ``block_words`` words.
   A source gives all its blocks as often as they fit the target whole, and
   then the first blocks of its order. In the block where the target is
   reached, documents are taken in order while they fit; past the first that
   does not, every later one that still fits is taken, in order, and the document
   whose size comes nearest to what is missing then completes it. Documents are
   taken whole.
3. *Tree*: the number of blocks of each source is an exact quota. Each node of
   a binary tree over the output shards draws its left child's blocks from its
   own without replacement, a multivariate hypergeometric draw, until every
   shard has its quota. Shards then take disjoint runs of each source's order.
4. *Shuffle*: inside a shard, copies are ordered by a hash.

Every draw depends on ``seed`` and on what it is drawn for, so reruns agree.

Defined results: a null text has no words; a null source is a source, the last
one; documents without words are taken when their block is, with 0 words;
an empty table gives an empty mix; repeated rows are taken each, as one place.
The driver holds one row per source, with the places of documents taken past the
one that did not fit: together they have fewer words than that one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from millrace.llm.texts import local_rows, whole_text, word_count
from millrace.session import materialize

WEIGHTS = (1, 2, 3)
REPEATS = 3
MAX_BLOCKS = 1 << 16  # of a source; more words make larger blocks
MOST_SOURCES = 100_000  # with more, the plan is joined without a broadcast
MOST_DRAWN = 1 << 29  # blocks in one hypergeometric draw; numpy's limit is 10^9
LEVELS = 6  # of the tree in one task


def fair_targets(sizes: list[int], weights: list[float], repeats: float = REPEATS) -> list[float]:
    """Shares by weight of the sum of sizes, none above ``repeats`` times its size."""
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        each = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if each * weights[i] > repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = each * weights[i]
            break
        full = set(over)
        for i in over:
            out[i] = float(repeats * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in full]
    return out


def place(key: str, source: str, seed: int) -> Column:
    """A document's fixed place in its source, 0 up to 2^31."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key), F.col(source)), 33)


def block_of(where: Column, blocks: Column) -> Column:
    return F.shiftright(where * blocks, 31)


def hint(plan: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(plan) if rows <= MOST_SOURCES else plan


def fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one source's candidates, by block and place, those that fit into what is short, one after the other."""
    left, places = int(rows["short"].iloc[0]), []
    for (_, at), size in rows.groupby(["block", "place"])["size"].sum().items():
        if size <= left:
            left -= size
            places.append(at)
    return pd.DataFrame({"number": rows["number"].iloc[:1], "places": [places], "short": [left]})


def fitting(free: DataFrame, sources: int) -> DataFrame:
    """``number``, ``places`` and what is ``short`` then. Candidates come from as
    many blocks as hold what is short, so a task gets little more than that and one block."""
    small = free.where("size > 0 and size <= short")
    through = small.groupBy("number", "block").agg(F.sum("size").alias("size"), F.first("short").alias("short")).withColumn(
        "before", F.sum("size").over(Window.partitionBy("number").orderBy("block")) - F.col("size")
    )
    last = through.where("before < short").groupBy("number").agg(F.max("block").alias("last_block"))
    near = small.join(hint(last, sources), "number").where("block <= last_block")
    return near.select("number", "block", "place", "size", "short").groupBy("number").applyInPandas(
        fit, "number int, places array<long>, short long"
    )


def make_plan(sized: DataFrame, weights: tuple, repeats: int, block_words: int) -> tuple[DataFrame, int]:
    """One row per source: target, blocks, passes, and where the last pass ends.
    ``sized`` has source, size and place of each document."""
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()
    shares = fair_targets([r.n for r in found], [weights[i % len(weights)] for i in range(len(found))], repeats)
    rows = []
    for number, (r, target) in enumerate(zip(found, shares)):
        blocks = min(MAX_BLOCKS, max(1, math.ceil(r.n / block_words)))
        passes = min(repeats, int(target // r.n)) if r.n else 0
        rows.append((number, r.source, r.n, target, blocks, passes, max(0.0, target - passes * r.n)))
    kind = sized.schema["source"].dataType.simpleString()
    base = local_rows(
        spark, rows, f"number int, source {kind}, source_size long, target double, blocks long, passes int, missing double"
    )
    of_source = lambda df: df.join(hint(base, len(rows)), df["source"].eqNullSafe(base["source"])).drop(base["source"])
    placed = of_source(sized).withColumn("block", block_of(F.col("place"), F.col("blocks")))
    order = Window.partitionBy("number")
    # a source has MAX_BLOCKS blocks at most
    blocks = placed.groupBy("number", "block").agg(F.sum("size").alias("size"), F.first("missing").alias("missing"))
    through = blocks.withColumn("end", F.sum("size").over(order.orderBy("block")))
    edge = through.where("end > missing").groupBy("number").agg(
        F.min(F.struct("block", (F.col("missing") - F.col("end") + F.col("size")).alias("rest"))).alias("e")
    ).select("number", F.col("e.block").alias("edge"), F.col("e.rest").alias("rest"))
    in_edge = placed.join(hint(edge, len(rows)), "number").where("block = edge")
    filled = in_edge.withColumn("end", F.sum("size").over(order.orderBy("place"))).where("end <= rest").groupBy("number").agg(
        F.max("place").alias("last_place"), F.max("end").alias("filled")
    )
    ends = edge.join(filled, "number", "left").select(
        "number", "edge", F.coalesce("last_place", F.lit(-1)).alias("last_place"),
        (F.col("rest") - F.coalesce("filled", F.lit(0))).alias("short"),
    )
    free = placed.join(hint(ends, len(rows)), "number").where("block > edge or block = edge and place > last_place")
    none = F.array().cast("array<long>")
    fitted = materialize(ends.join(fitting(free, len(rows)).withColumnRenamed("short", "left"), "number", "left").select(
        "number", "edge", "last_place", F.coalesce("left", "short").alias("short"), F.coalesce("places", none).alias("places")
    ))
    open_ = free.select("number", "place", "size").join(hint(fitted, len(rows)), "number").where(~F.array_contains("places", F.col("place")))
    gap = F.abs(F.col("size") - F.col("short"))
    extra = open_.where(gap < F.col("short")).groupBy("number").agg(F.min(F.struct(gap.alias("gap"), "place")).alias("x")).select(
        "number", F.array("x.place").alias("nearest")
    )
    fitted = fitted.join(extra, "number", "left").withColumn("places", F.concat("places", F.coalesce("nearest", none)))
    # One row per source, so the driver may hold it.
    tail = {r.number: r for r in fitted.collect()}
    plan = []
    for number, source, size, target, count, passes, missing in rows:
        t = tail.get(number)
        edge_block = (t.edge if t else count) if missing > 0 else -1
        plan.append((
            number, source, size, target, count, passes, edge_block, t.last_place if t and missing > 0 else -1,
            t.places if t and missing > 0 else [],
            passes * count + min(edge_block + 1, count),
        ))
    return local_rows(
        spark, plan, f"number int, source {kind}, source_size long, target double, blocks long, passes int, "
        "edge long, last_place long, places array<long>, quota long"
    ), len(plan)


def copies(where: Column, block: Column, plan: Column) -> Column:
    """How often the mix takes a document, given its source's plan."""
    drawn = (block < plan["edge"]) | (block == plan["edge"]) & (where <= plan["last_place"]) | F.array_contains(plan["places"], where)
    return F.least(plan["passes"] + F.when(drawn, 1).otherwise(0), F.lit(REPEATS))


def halve(quota: np.ndarray, random: np.random.Generator, most: int = MOST_DRAWN) -> np.ndarray:
    """Half of the blocks (rounded down), drawn without replacement. More than
    ``most`` are dealt evenly to parts first, each of which is drawn from."""
    parts = 1 + int(quota.sum()) // most
    taken, left, through = 0, np.zeros_like(quota), 0
    for part in range(parts):
        own = quota // parts + (part < quota % parts)
        through += int(own.sum())
        left += random.multivariate_hypergeometric(own, through // 2 - taken, method="marginals")
        taken = through // 2
    return left


def splitter(begun: int, levels: int, seed: int):
    """A function that splits the rows of one node at level ``begun`` by ``levels`` levels."""

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        numbers, level = rows["number"].to_numpy(), {int(rows["node"].iloc[0]): rows["quota"].to_numpy()}
        for at in range(begun, begun + levels):
            below = {}
            for node, quota in level.items():
                random = np.random.default_rng([seed, at, node])
                left = halve(quota, random)
                below[2 * node], below[2 * node + 1] = left, quota - left
            level = below
        return pd.concat([pd.DataFrame({"node": n, "number": numbers, "quota": q})[q > 0] for n, q in level.items()])

    return split


def split_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """``node``, ``number``, ``quota`` of each of the 2^depth shards (nodes
    numbered from 0), from ``number``, ``quota``. A task splits one node by up
    to ``LEVELS`` levels; it holds one row per source and node below."""
    nodes = quotas.select(F.lit(0).cast("long").alias("node"), "number", "quota")
    done = 0
    while done < depth:
        levels = min(LEVELS, depth - done)
        nodes = nodes.groupBy("node").applyInPandas(splitter(done, levels, seed), "node long, number int, quota long")
        done += levels
    return nodes


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS,
        repeats: int = REPEATS, block_words: int = 1 << 13, shard_words: int = 1 << 20, seed: int = 1,
        size: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The plan, one row per source, and the mix: each column of ``docs`` with
    ``_number`` (of the source), ``_copy``, ``_shard`` and ``_order``, one row
    per copy taken. ``size`` stands for the word count where it is known."""
    where = place(key, source, seed)
    counted = word_count(whole_text(text)) if size is None else size
    sized = materialize(docs.select(F.col(source).alias("source"), counted.alias("size"), where.alias("place")))
    plan, rows = make_plan(sized, weights, repeats, block_words)
    total = plan.agg(F.sum("target")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1.0, total / shard_words))))
    shards = split_tree(plan.where("quota > 0").select("number", "quota"), depth, seed)
    before = Window.partitionBy("number").orderBy("node")
    slots = shards.withColumn("end", F.sum("quota").over(before)).select(
        F.col("number").alias("_number"), F.col("node").alias("_shard"),
        F.explode(F.sequence(F.col("end") - F.col("quota"), F.col("end") - 1)).alias("_slot"),
    )
    small = hint(plan.select(F.col("source").alias("_source"), F.struct("*").alias("_plan")), rows)
    of = F.col("_plan")
    block = block_of(where, of["blocks"])
    slot = F.col("_copy") * of["blocks"] + F.when(F.col("_copy") < of["passes"], block).otherwise(F.least(block, of["edge"]))
    own = [F.col(f"`{c}`") for c in docs.columns]
    taken = (
        docs.join(small, F.col(source).eqNullSafe(F.col("_source"))).withColumn("_n", copies(where, block, of)).where("_n > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .select(*own, of["number"].alias("_number"), "_copy", slot.alias("_slot"))
    )
    order = F.xxhash64(F.lit(seed), "_shard", F.col(key), "_copy")
    return plan, taken.join(slots, ["_number", "_slot"]).select(*own, "_number", "_copy", "_shard", order.alias("_order"))


def shuffled(mixed: DataFrame) -> DataFrame:
    """The mix dealt out by shard, each shard in its own order."""
    return mixed.repartition("_shard").sortWithinPartitions("_shard", "_order")
