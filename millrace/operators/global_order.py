"""Row numbers, ranks and running totals over a whole table.

A window without PARTITION BY sends every row to one task. Here the rows are
range-partitioned on (value, tie key), numbered inside their partition, and
shifted by offsets taken from one summary row per partition. The tie key makes
the order total, so a value shared by a third of all rows still spreads over
many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.session import materialize


ROWS_IN_PART = 33  # low bits of a monotonically increasing id: the row's number in its partition


def number_globally(
    df: DataFrame, value: str, ties: Sequence[str], *, descending: bool = True, partitions: int | None = None
) -> DataFrame:
    """Add ``row_no``, from 1 on, of the order by ``value`` and ``ties``.

    One exchange: rows are range-partitioned and sorted in their partition, and
    the id that Spark gives them there holds the partition's number and the
    row's. What lies before a partition is summed over one row per partition."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(value).desc() if descending else F.col(value).asc(), *[F.col(t) for t in ties]]
    numbered = materialize(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    )
    part, row = F.shiftright("_id", ROWS_IN_PART), F.col("_id").bitwiseAND((1 << ROWS_IN_PART) - 1)
    placed = numbered.withColumns({"_part": part, "_row": row + 1})
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # as many rows as partitions
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_row") + F.col("_before")).alias("row_no"))


def order_globally(
    df: DataFrame,
    value: str,
    ties: Sequence[str],
    *,
    descending: bool = True,
    running: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``row_no``, ``rank`` and ``dense_rank`` of ``value`` over all rows and,
    when ``running`` names a column, its inclusive prefix sum ``running_total``.

    ``ties`` must make (value, ties) unique. Runs one job: the numbered rows
    are materialised so that partition numbers cannot move on recomputation.
    Where row numbers are enough, ``number_globally`` takes one exchange less.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(value).desc() if descending else F.col(value).asc()
    in_part = W.partitionBy("_part")
    total_order = in_part.orderBy(key, *ties)
    by_value = in_part.orderBy(key)

    local = {
        "_row": F.row_number().over(total_order),
        "_rank": F.rank().over(by_value),
        "_dense": F.dense_rank().over(by_value),
    }
    if running:
        local["_running"] = F.sum(running).over(total_order.rowsBetween(W.unboundedPreceding, W.currentRow))
    numbered = materialize(
        df.repartitionByRange(parts, key, *ties)
        .withColumn("_part", F.spark_partition_id())
        .withColumns(local)
    )

    offsets = _part_offsets(numbered, value, running)
    starts_here = ~(F.col("_joined") & F.col(value).eqNullSafe(F.col("_first")))
    result = numbered.join(F.broadcast(offsets), "_part").withColumns(
        {
            "row_no": F.col("_row") + F.col("_rows_before"),
            "rank": F.when(starts_here, F.col("_rank") + F.col("_rows_before")).otherwise(F.col("_open_start")),
            "dense_rank": F.col("_dense") + F.col("_dense_before"),
        }
    )
    if running:
        result = result.withColumn("running_total", F.col("_running") + F.col("_sum_before"))
    added = ["row_no", "rank", "dense_rank"] + (["running_total"] if running else [])
    return result.select(*df.columns, *added)


def _part_offsets(numbered: DataFrame, value: str, running: str | None) -> DataFrame:
    """One row per partition: what lies before it. Its size is the partition
    count, never the data, which is what makes the window and the broadcast safe."""
    summary = numbered.groupBy("_part").agg(
        F.count("*").alias("_n"),
        F.max("_dense").alias("_values"),
        F.max("_rank").alias("_last_rank"),
        F.min_by(value, "_row").alias("_first"),
        F.max_by(value, "_row").alias("_last"),
        *([F.sum(running).alias("_sum")] if running else []),
    )
    chain = W.partitionBy(F.lit(0)).orderBy("_part")
    before = chain.rowsBetween(W.unboundedPreceding, -1)
    up_to = chain.rowsBetween(W.unboundedPreceding, W.currentRow)
    summary = summary.withColumns(
        {
            "_rows_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            # the first value of this partition is the last value of the one before
            "_joined": F.coalesce(
                (F.lag("_part").over(chain).isNotNull())
                & F.col("_first").eqNullSafe(F.lag("_last").over(chain)),
                F.lit(False),
            ),
        }
    )
    opens = (F.col("_values") > 1) | ~F.col("_joined")
    summary = summary.withColumns(
        {
            "_dense_before": F.coalesce(F.sum("_values").over(before), F.lit(0))
            - F.sum(F.col("_joined").cast("int")).over(up_to),
            "_last_start": F.when(opens, F.col("_rows_before") + F.col("_last_rank")),
        }
    )
    summary = summary.withColumn("_open_start", F.last("_last_start", ignorenulls=True).over(before))
    keep = ["_part", "_rows_before", "_dense_before", "_joined", "_first", "_open_start"]
    if running:
        summary = summary.withColumn(
            "_sum_before", F.coalesce(F.sum("_sum").over(before), F.lit(0).cast("decimal(38,4)"))
        )
        keep.append("_sum_before")
    return summary.select(*keep)


def bounded_dense_rank(df: DataFrame, value: str, name: str, *, descending: bool = True) -> DataFrame:
    """Dense rank over a frame already cut to a fixed number of rows, such as a
    top-k report or a list of model families. Not for data-sized input."""
    key = F.col(value).desc() if descending else F.col(value).asc()
    return df.withColumn(name, F.dense_rank().over(W.partitionBy(F.lit(0)).orderBy(key)))
