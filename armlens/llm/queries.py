"""Registered queries of the corpus operators: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies one operator with its production parameters to the whole table
and returns one digest row per document (op12: one per phrase).
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import functions as F

from armlens.llm import (byte_bpe, fill_middle, line_dedup, lm_scoring, mixing, near_dup, personal_data, phrases, quality,
                         sharding, token_files, topk_search, toxicity)
from armlens.llm.common import read_table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_mixing(spark, sf_dir):
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "draws")


def op2_token_files(spark, sf_dir):
    return token_files.token_files(read_table(spark, sf_dir, "documents"), tokenizers.path(WORD_TOKENIZER))


def op3_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("row.doc_id", toxicity.holds_out(F.col("row.doc_id")).alias("held_out"),
                         "score", "predicted", "offending")


def op4_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents")).drop("tag")


def op5_lm_scoring(spark, sf_dir):
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    ratios = quality.log_ratios(docs, quality.trusted_ids(read_table(spark, sf_dir, "labels")))
    return quality.score_documents(docs, ratios)


def op7_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_passages(docs).select(
        "row.doc_id", F.col("clean").alias("text"), "n_lines", "n_removed", "n_chunks")


def op8_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_documents(read_table(spark, sf_dir, "documents"), tokenizers.path(BYTE_RANKS),
                                     tokenizers.PATTERN)


def op9_topk_search(spark, sf_dir):
    return topk_search.search(read_table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


def op10_sharding(spark, sf_dir):
    return sharding.assign_shards(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_fill_middle(spark, sf_dir):
    cut = fill_middle.transform(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return cut.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


def op12_phrases(spark, sf_dir):
    return phrases.mine(read_table(spark, sf_dir, "documents"))


def personal_digest(found):
    """Digest columns of the spans that ``personal_data.find`` returns."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("row.doc_id", *[count(k) for k in personal_data.KINDS],
                        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", text), ",").alias("spans"),
                        (F.size("spans") - F.size(base)).cast("long").alias("n_added"))


def op13_personal_data(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_digest(personal_data.find(docs, personal_data.train(docs), keep=["doc_id"]))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_near_dup": op4_near_dup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_topk_search": op9_topk_search,
    "op10_sharding": op10_sharding,
    "op11_fill_middle": op11_fill_middle,
    "op12_phrases": op12_phrases,
    "op13_personal_data": op13_personal_data,
}
