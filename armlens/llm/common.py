"""Shared helpers of the corpus operators: reading, staging, word rules, offsets.

Word rule of every operator: a word is a maximal run of characters other than
space, tab, newline, vertical tab, form feed and carriage return. On UTF-8
bytes that is exactly ``bytes.split()``, and ``bytes.lower()`` lower-cases A-Z
only, so Python stages use those two calls.
"""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.session import ensure_checkpoint_dir

# Fixed values of the word rule.
SPACE_CHARS = " \t\n\x0b\f\r"
WORD_PATTERN = r"([^\x20\x09-\x0D]+)"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

# Size of an Arrow batch: bounds a Python worker's memory.
ARROW_ROWS = 1000
ARROW_BYTES = 32_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, by any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python stages over whole texts get at most ``ARROW_ROWS`` texts, or about
    ``ARROW_BYTES`` of them, at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def releasing(work):
    """``work`` (batches -> batches) that gives its freed memory back to the system at the end: Spark keeps a
    Python worker for later tasks, beside the JVM that then needs the memory."""
    def run(batches):
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library
    return run


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read
    it back: a cut of the lineage that survives lost executors. ``options``: of the writer."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a text; NULL and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_PATTERN))


def running_offsets(df: DataFrame, index: str, value: str, out: str, fan: int = 4096) -> DataFrame:
    """``out`` = sum of ``value`` over rows with a smaller ``index`` (unique
    non-negative integers). Two levels: windows inside blocks of ``fan``
    consecutive indexes, then one window over the block totals only."""
    from pyspark.sql import Window as W
    blocked = df.withColumn("_blk", F.floor(F.col(index) / fan))
    inside = W.partitionBy("_blk").orderBy(index).rowsBetween(W.unboundedPreceding, -1)
    part = blocked.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = blocked.groupBy("_blk").agg(F.sum(value).alias("_tot"))
    before = W.orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("_blk", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_base"))
    return (part.join(totals, "_blk").withColumn(out, (F.col("_in") + F.col("_base")).cast("long"))
            .drop("_blk", "_in", "_base"))
