"""Score review files as they arrive, each file once.

The batch rule "only reviews without a score" as a file stream: the stream
checkpoint remembers which files were read, and a micro-batch that is repeated
after a failure overwrites its own output folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.sentiment import sentiment_score, unscored

REVIEW_COLUMNS = "review_id string, title string, message string, sentiment_score decimal(5,4)"


def score_new_reviews(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    lexicon: DataFrame,
    negations: Sequence[str] = ("not", "no", "never"),
) -> None:
    """Work through all files not seen before, then stop."""

    def write(batch: DataFrame, number: int) -> None:
        scores = sentiment_score(unscored(batch), lexicon, negations)
        scores.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(REVIEW_COLUMNS).parquet(source)
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_scores(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).select("review_id", F.col("sentiment_score"))
