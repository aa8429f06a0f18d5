"""Exact deduplication by salted combining of digests, with full content compared.

1. *Locally and per salt*: rows are grouped by (digest, salt, text). Spark
   combines equal texts inside each map task first; the salt, taken from the
   id, spreads a text that holds a third of all rows over ``salts`` groups.
2. *Globally*: the winners of all salts are grouped by (digest, text).

The text is part of both grouping keys, so content is compared in full and
two texts that share a digest stay apart. No group is ever collected.

Defined results: a null text counts as the empty text; a null id is smaller
than any other; an empty table gives an empty result. Rows that repeat both
id and text are one document: ``groups`` counts each and marks each as kept,
``distinct_rows`` returns one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import whole_text
from millrace.session import materialize

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def combined(keyed: DataFrame, best: Column, again: Column, salts: int) -> DataFrame:
    """``_digest``, ``_text`` and what ``best`` and ``again`` keep of each distinct text."""
    salted = keyed.groupBy("_digest", "_salt", "_text").agg(best, F.count(F.lit(1)).alias("_rows"))
    return salted.repartition("_digest").groupBy("_digest", "_text").agg(again, F.sum("_rows").alias("_rows"))


def keyed(docs: DataFrame, columns: list[Column], key: str, text: str, digest, salts: int) -> DataFrame:
    narrow = docs.select(*columns, whole_text(text).alias("_text"), F.pmod(F.xxhash64(F.col(key)), F.lit(salts)).alias("_salt"))
    return narrow.withColumn("_digest", digest(F.col("_text")))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row per document: ``key``, keep_id, group_size, kept, digest.

    What goes back to the documents is one row per digest without its text.
    Only documents whose digest stands for several texts are joined by text.
    """
    rows = keyed(docs, [F.col(key).alias("_id")], key, text, digest, salts)
    merged = combined(rows, F.max("_id").alias("_id"), F.max("_id").alias("_id"), salts)
    winners = materialize(
        merged.groupBy("_digest").agg(F.count(F.lit(1)).alias("_texts"), F.max("_id").alias("keep_id"), F.max("_rows").alias("group_size"))
    )
    single = winners.where("_texts = 1").drop("_texts")
    found = rows.select("_id", "_digest").join(single, "_digest")
    shared = winners.where("_texts > 1").select("_digest")
    if not shared.isEmpty():  # digests that stand for several texts
        of_text = merged.join(shared, "_digest", "left_semi").select(
            "_digest", "_text", F.col("_id").alias("keep_id"), F.col("_rows").alias("group_size")
        )
        found = found.unionByName(
            rows.join(shared, "_digest", "left_semi").join(of_text, ["_digest", "_text"])
            .select("_digest", "_id", "keep_id", "group_size")
        )
    return found.select(
        F.col("_id").alias(key), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_digest").alias("digest"),
    )


def distinct_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256, salts: int = SALTS) -> DataFrame:
    """The whole row with the largest ``key`` of each distinct text."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.col(text).isNull().alias("_null"))
    order = F.struct("_id", "_rest")
    kept = keyed(docs, [F.col(key).alias("_id"), F.xxhash64(row).alias("_rest"), row.alias("_row")], key, text, digest, salts)
    best = F.max_by(F.struct("_id", "_rest", "_row"), order).alias("_best")
    again = F.max_by("_best", F.struct("_best._id", "_best._rest")).alias("_best")
    merged = combined(kept, best, again, salts)
    whole = F.when(~F.col("_best._row._null"), F.col("_text")).alias(text)
    return merged.select(*[whole if c == text else F.col(f"_best._row.`{c}`").alias(c) for c in docs.columns])
