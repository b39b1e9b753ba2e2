"""Phrase mining over sorted count streams (operator 12).

A phrase is two or three words in a row inside a piece of text. It is scored by
the worse of its cuts, a * a / (l * r), where a, l and r are the occurrences of
the phrase, of its part before the cut and of its part after it. A phrase that a
longer one mostly covers goes.

Layout, after the external stream estimation of n-gram models:

1. ``streams``: every task turns its texts, ``CHUNK_BYTES`` at a time, into word
   numbers of the chunk and writes them beside the chunk's word counts.
2. Word counts are added up per language; words with ``min_count`` occurrences
   get numbers in sorted order. A phrase holds no rarer word, so nothing is lost.
   Each chunk meets the numbers of its own words (``cogroup``: a chunk is bounded
   by its bytes, so neither the text nor the vocabulary ever sits in one place).
3. A chunk's numbers are sorted as pairs and as triples: runs of sorted, counted
   n-grams. The runs are merged by one shuffle.
4. Pairs merge with the word stream in prefix order (left counts) and in suffix
   order (right counts); triples merge with the pair stream by their first pair
   and by their last pair, which gives both cuts and, the other way, the longest
   extension of every pair. All of these are sort-merge joins on numbers; a
   frequent word's stretch of the stream is split by the adaptive plan.

Arithmetic is exact: products are decimals of 38 digits (up to 10**14 words).

Defined cases: NULL, empty and blank texts have no words; a NULL language is
``und``; very long texts are read whole, one text is never split over chunks;
repeated rows count again; ties go by count, then phrase in byte order; an empty
table gives no rows; other columns are never read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from armlens.llm.common import small_batches, staged

# Fixed values of the word rule: these end a piece; space and tab end a word.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

CHUNK_BYTES = 32_000_000
_OUT_ROWS = 200_000
_SALTS = 256
_TOKEN = re.compile(rb"[^ \t\n]+|\n")
_TABLE = bytes.maketrans(bytes(range(65, 91)) + PIECE_ENDS, bytes(range(97, 123)) + b"\n" * len(PIECE_ENDS))

_STREAMS = "chunk long, lang string, word string, local int, n long, ids binary"


class _Vocabulary:
    """Numbers of the words of one language in one chunk; 0 ends a piece."""

    def __init__(self):
        self.numbers = defaultdict(count().__next__)
        self.numbers[b"\n"]
        self.runs = []

    def add(self, text: bytes) -> None:
        tokens = _TOKEN.findall(text.translate(_TABLE))
        tokens.append(b"\n")
        self.runs.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))

    def rows(self, chunk: int, lang: str):
        ids = np.concatenate(self.runs)
        n = np.bincount(ids, minlength=len(self.numbers))
        words = list(self.numbers)
        for a in range(1, len(words), _OUT_ROWS):
            some = words[a:a + _OUT_ROWS]
            k = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * k, pa.int64()), pa.array([lang] * k, pa.string()),
                 pa.array(some, pa.binary()).cast(pa.string()), pa.array(np.arange(a, a + k, dtype=np.int32)),
                 pa.array(n[a:a + k]), pa.nulls(k, pa.binary())], ["chunk", "lang", "word", "local", "n", "ids"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([lang]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()),
             pa.nulls(1, pa.int64()), pa.array([ids.tobytes()], pa.binary())],
            ["chunk", "lang", "word", "local", "n", "ids"])


def streams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Chunks of texts as word numbers (``ids``) and the counted words of each chunk (``word``), staged."""
    small_batches(docs.sparkSession)
    own = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                      F.col(text_col).alias("text")).filter(F.length("text") > 0)

    def encode(batches):
        chunk = TaskContext.get().partitionId() << 32
        held, spoken = 0, defaultdict(_Vocabulary)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                spoken[lang].add(text)
                held += len(text)
                if held >= CHUNK_BYTES:
                    for lang_, vocabulary in spoken.items():
                        yield from vocabulary.rows(chunk, lang_)
                    chunk, held, spoken = chunk + 1, 0, defaultdict(_Vocabulary)
        for lang_, vocabulary in spoken.items():
            yield from vocabulary.rows(chunk, lang_)

    return staged(own.mapInArrow(encode, _STREAMS), "phrase-streams")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``id``: gapless numbers from 0 in sorted order, staged."""
    rows = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("at", F.monotonically_increasing_id()), "phrase-words")
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))  # one row a partition
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    return (rows.withColumn("part", part).join(F.broadcast(sizes), "part")
            .withColumn("id", F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "at", "base"))


def _counted(sorted_keys: np.ndarray):
    """Distinct values of a sorted run and how often each occurs."""
    if not len(sorted_keys):
        return sorted_keys, np.empty(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
    return sorted_keys[at], np.diff(np.append(at, len(sorted_keys)))


def _runs(ids: np.ndarray):
    """Sorted, counted pairs and triples of word numbers (-1: none), a pair as first << 32 | second."""
    both = (ids[:-1] >= 0) & (ids[1:] >= 0)
    pairs = (ids[:-1] << 32) | np.maximum(ids[1:], 0)
    distinct, n = _counted(np.sort(pairs[both]))
    at = np.flatnonzero(both[:-1] & both[1:])
    order = np.searchsorted(distinct, pairs[at])  # a pair's place keeps the order of pairs
    triples, m = _counted(np.sort((order << 32) | ids[at + 2]))
    return distinct, n, distinct[triples >> 32], triples & 0xFFFFFFFF, m


def n_grams(chunks: DataFrame, words: DataFrame, min_count: int) -> DataFrame:
    """(pair, third, a): pairs (third NULL) and triples of the words in ``words`` with at least ``min_count`` occurrences."""
    vocabulary = chunks.filter("word is not null").select("chunk", "lang", "word", "local")
    vocabulary = vocabulary.join(words.select("lang", "word", "id").hint("merge"), ["lang", "word"])
    texts = chunks.filter("ids is not null").select(F.col("chunk").alias("of"), F.col("lang").alias("spoken"), "ids")

    def merge(texts: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        local = known.column("local").to_numpy()
        number = known.column("id").to_numpy()
        for held in texts.column("ids").to_pylist():
            ids = np.frombuffer(held, np.int32)
            of = np.full(int(ids.max(initial=0)) + 1, -1, np.int64)
            of[local] = number
            distinct, n, firsts, thirds, m = _runs(of[ids])
            for pair, third, a in ((distinct, None, n), (firsts, thirds, m)):
                third = pa.nulls(len(pair), pa.int64()) if third is None else pa.array(third)
                out += pa.Table.from_arrays([pa.array(pair), third, pa.array(a)],
                                            ["pair", "third", "n"]).to_batches(_OUT_ROWS)
        return pa.Table.from_batches(out, pa.schema([("pair", pa.int64()), ("third", pa.int64()), ("n", pa.int64())]))

    runs = (texts.groupBy("of", "spoken").cogroup(vocabulary.select("chunk", "lang", "local", "id").groupBy("chunk", "lang"))
            .applyInArrow(merge, "pair long, third long, n long"))
    # a run holds an n-gram once: dealt first, so that no map side builds a table of its run in vain
    return (runs.repartition("pair", "third").groupBy("pair", "third").agg(F.sum("n").alias("a"))
            .filter(F.col("a") >= min_count))


def _score(left: str, right: str):
    wide = "cast({} as decimal(14,0))".format
    return F.expr(f"({wide('a')} * {wide('a')} * 1000000) div ({wide(left)} * {wide(right)})")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, top: int = 2000,
         covered_percent: int = 50) -> DataFrame:
    """Per language its ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    chunks = streams(docs, text_col, lang_col)
    counted = chunks.filter("word is not null")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = numbered(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count),
                     "lang", "word")
    grams = staged(n_grams(chunks, words, min_count), "phrase-grams")

    first = words.select(F.col("id").alias("one"), "lang", F.col("word").alias("head"), F.col("f").alias("l"))
    last = words.select(F.col("id").alias("two"), F.col("word").alias("tail"), F.col("f").alias("r"))
    pairs = grams.filter("third is null").select("pair", "a", F.shiftright("pair", 32).alias("one"),
                                                 F.col("pair").bitwiseAND(0xFFFFFFFF).alias("two"))
    pairs = pairs.join(first.hint("merge"), "one").join(last.hint("merge"), "two")  # prefix order, then suffix order
    pairs = staged(pairs.select("pair", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "tail", "a", "l", "r"),
                   "phrase-pairs")

    triples = grams.filter("third is not null").select(
        "pair", F.shiftleft(F.col("pair").bitwiseAND(0xFFFFFFFF), 32).bitwiseOR(F.col("third")).alias("end"), "a")
    begin = pairs.select("pair", "lang", "phrase", F.col("l").alias("l1"), F.col("a").alias("l2"))
    end = pairs.select(F.col("pair").alias("end"), "tail", F.col("a").alias("r1"), F.col("r").alias("r2"))
    triples = triples.join(begin.hint("merge"), "pair").join(end.hint("merge"), "end")
    triples = triples.withColumn("s1", _score("l1", "r1")).withColumn("s2", _score("l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    triples = staged(triples.select(
        "pair", "end", "lang", F.concat_ws(" ", "phrase", "tail").alias("phrase"), "a",
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score")), "phrase-triples")

    longer = (triples.select("pair", "a").unionByName(triples.select(F.col("end").alias("pair"), "a"))
              .groupBy("pair").agg(F.max("a").alias("longest")))
    free = (pairs.join(longer.hint("merge"), "pair", "left")
            .filter(F.col("longest").isNull() | (100 * F.col("longest") < covered_percent * F.col("a")))
            .withColumn("score", _score("l", "r")))
    found = ["lang", "phrase", "a", "l", "r", "score"]
    found = free.select(*found).unionByName(triples.select(*found))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are ranked in shares first, so no task holds them all
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order)))
    best = salted.filter(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            "n", "score")
