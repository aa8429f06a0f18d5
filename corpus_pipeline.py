"""From raw documents to token ids, in five stages.

Each stage works on all its predecessor kept and returns rows of documents;
the last returns token ids and the digest of what they decode to. ``run`` writes what each stage returns as Parquet
below the shared checkpoint folder and reads it again, so a lost executor
costs no more than the stage it was lost in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe_fst, exact_dedup, queries, simhash_anchor, source_mix, texts, toxicity_fm
from millrace.session import shared_folder

TOXIC = 0.5  # documents that score as much go


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC``; the machine learns from all labelled ones."""
    labels = queries.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    machine = toxicity_fm.fit(docs, labels)
    texts.bound_batches(spark)
    return docs.where(toxicity_fm.score_column(machine) < TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.distinct_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash, the document with the smallest id."""
    return simhash_anchor.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, dealt out by shard and shuffled."""
    _, mixed = source_mix.mix(docs)
    return source_mix.shuffled(mixed).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (packed unsigned 32-bit integers), and the digest of the text they decode to."""
    return bpe_fst.encode_texts(docs, queries.RANKS, queries.PATTERN, ["doc_id", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

# Scores, fingerprint components and BPE have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = queries.table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
