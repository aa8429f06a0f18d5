"""Lexicon sentiment of review texts.

A text is split into tokens inside its row; each token knows whether one of
the tokens before it is a negation. Tokens are then looked up in the lexicon by
a join and summed per review. The sum is pre-aggregated in the task that read
the text, so about one row per review is shuffled, never the tokens.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.fixed_values import SENTIMENT_NEGATION_FACTOR, SENTIMENT_NORMALISER

WEIGHT = "decimal(10,4)"


def review_text(title: str = "title", message: str = "message"):
    return F.trim(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(message, F.lit(""))))


def sentiment_score(
    reviews: DataFrame, lexicon: DataFrame, negations: Sequence[str] = ("not", "no", "never"), window: int = 3
) -> DataFrame:
    """(review_id, sentiment_score) of reviews(review_id, title, message).

    ``lexicon`` holds (token, weight). The token weights are added, a weight
    after a negation within ``window`` tokens is damped and turned round, and
    the sum is squeezed into [-1, 1]; a blank text scores 0."""
    tokens = F.regexp_extract_all(F.lower(review_text()), F.lit(r"([\p{L}']+)"), F.lit(1))

    def negated(i):
        before = [F.get("words", i - k).isin(*negations) for k in range(1, window + 1)]
        return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in before]), F.lit(False))

    flagged = F.transform("words", lambda word, i: F.struct(word.alias("token"), negated(i).alias("negated")))
    words = (
        reviews.select("review_id", tokens.alias("words"))
        .select("review_id", F.explode_outer(flagged).alias("word"))
        .select("review_id", "word.token", "word.negated")
    )
    weight = F.col("weight").cast(WEIGHT)
    signed = F.when(F.col("negated"), weight * F.lit(str(SENTIMENT_NEGATION_FACTOR)).cast("decimal(4,2)")).otherwise(
        weight.cast("decimal(14,6)")
    )
    total = F.sum(F.coalesce(signed, F.lit(0).cast("decimal(14,6)")))
    return (
        words.join(lexicon.select("token", "weight"), "token", "left")
        .groupBy("review_id")
        .agg(total.cast("double").alias("total"))
        .select(
            "review_id",
            F.round(
                (F.col("total") / F.sqrt(F.col("total") * F.col("total") + SENTIMENT_NORMALISER)).cast("decimal(30,10)"), 4
            )
            .cast("decimal(5,4)")
            .alias("sentiment_score"),
        )
    )


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    """How many reviews lie above, within and below the +-0.05 band, and the mean."""
    score = F.col("sentiment_score").cast("double")
    return scored.agg(
        F.count_if(score > 0.05).alias("positive"),
        F.count_if(score.between(-0.05, 0.05)).alias("neutral"),
        F.count_if(score < -0.05).alias("negative"),
        F.round(F.avg(score).cast("decimal(30,10)"), 3).cast("double").alias("mean"),
    )


def unscored(reviews: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """Reviews without a score, here or in a table of earlier scores."""
    waiting = reviews.filter(F.col("sentiment_score").isNull())
    return waiting if scored is None else waiting.join(scored.select("review_id"), "review_id", "left_anti")


def merge_scores(reviews: DataFrame, scores: DataFrame) -> DataFrame:
    """New scores written over missing ones in one keyed join."""
    new = scores.select("review_id", F.col("sentiment_score").alias("_new"))
    return (
        reviews.join(new, "review_id", "left")
        .withColumn("sentiment_score", F.coalesce("sentiment_score", "_new"))
        .drop("_new")
    )


def sentiment_backfill(
    reviews: DataFrame,
    lexicon: DataFrame,
    scored: DataFrame | None = None,
    negations: Sequence[str] = ("not", "no", "never"),
    window: int = 3,
) -> DataFrame:
    """Score what is unscored and merge; scores that exist are not recomputed."""
    scores = sentiment_score(unscored(reviews, scored), lexicon, negations, window)
    if scored is not None:
        scores = scores.unionByName(scored.select("review_id", "sentiment_score"))
    return merge_scores(reviews, scores)


def scored_count(reviews: DataFrame) -> DataFrame:
    return reviews.agg(F.count("sentiment_score").alias("scored"), F.count("*").alias("reviews"))
