"""Corpus pipeline: documents in, token ids out.

Stages, each on all that its predecessor kept: documents predicted toxic go (3),
repeated line chunks and passages go (7), of each near-duplicate group one document stays
(4, five-word shingles), sources are mixed to their target weights, documents
repeated or left out accordingly (1), and every text is encoded to byte-level
BPE ids and decoded again (8). All stages but the last return the columns of
``documents``; extra columns pass through. ``run`` writes each stage's rows to
the shared checkpoint folder and reads them back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.llm import byte_bpe, line_dedup, mixing, near_dup, toxicity
from armlens.llm.common import read_table, staged

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents predicted toxic go."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).filter("predicted = 0").select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: repeated line chunks and passages leave the texts; n_chars follows the text."""
    cleaned = line_dedup.dedup_passages(docs)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return cleaned.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each near-duplicate group stays."""
    return near_dup.keep_one(docs).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents as often as the mix draws them, in seeded order within a task's rows."""
    return mixing.mixed_documents(docs).sortWithinPartitions("shard", "place").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token ids of every text, with digests of the ids and of the decoded bytes."""
    return byte_bpe.encode_documents(docs, tokenizers.path(RANKS), tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

ORACLE_SQL = None  # a fitted classifier and BPE have no SQL form: tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
