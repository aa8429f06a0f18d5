"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

SLICE = 1 << 22  # bytes of text in Python at once, besides the Arrow batch
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
WORD = r"[^\x20\x09-\x0D]+"  # what the operators call a word


def whole_text(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of about ``SLICE`` bytes, unless the session asks for
    smaller ones. By rows alone a batch takes 10,000 texts, which lie beside the
    JVM's heap and in Python at once. The setting stays, since plans run later."""
    own = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(BATCH).lower())
    if not own or int(own[1]) << 10 * " kmgtp".index(own[2] or " ") > SLICE:
        spark.conf.set(BATCH, f"{SLICE}b")


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a DataFrame. They go as one Arrow table: a list
    would go through Python workers that are kept apart from those of the other stages."""
    names = StructType.fromDDL(schema).names
    columns = zip(*rows) if rows else [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(list(c)) for n, c in zip(names, columns)}), schema)


def map_texts(
    df: DataFrame, keys: list[str], text: str, rows: Callable[[list[str]], dict[str, list]], schema: str,
    end: Callable[[], None] = lambda: None,
) -> DataFrame:
    """``keys`` kept as they are, with what ``rows`` makes of each whole text.

    ``rows`` gets some texts of an Arrow batch, about ``SLICE`` bytes of them
    (a longer text comes alone), and returns one list per new column; ``end`` is
    called after a task's last text. No shuffle: the work stays where the scan is.
    """
    bound_batches(df.sparkSession)
    narrow = df.select(*keys, whole_text(text).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(len(keys))).to_numpy()
            parts = np.cumsum(sizes) // SLICE
            for lo, hi in pairwise([0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]):
                some = batch.slice(lo, hi - lo)
                made = rows(some.column(len(keys)).to_pylist())
                yield pa.RecordBatch.from_pydict({k: some.column(i) for i, k in enumerate(keys)} | made)
        end()
        pa.default_memory_pool().release_unused()

    return narrow.mapInArrow(run, f"{kept}, {schema}" if kept else schema)
