"""Sharding by a two-pass external shuffle (operator 10, DataFrame functions only).

Pass 1 scatters whole records into buckets by a seeded hash, uniformly, as many
buckets as keep each within ``bucket_rows`` records and ``bucket_bytes`` bytes on
average, so a bucket fits in memory whatever the input. Pass 2 shuffles each
bucket by Fisher-Yates with seeded draws, numbers the records and writes them to
their shards: rank = records in earlier buckets + place in the bucket. Law
``rows``: shard = rank mod shards, slot = rank div shards, so counts are at most
one apart and slots are gapless. The rows of a task stand in its file of a shard
in order of slot; no task holds a whole shard, and texts are shuffled once.
``assign_shards`` reports on the shards that were written, by reading them back.

Nothing depends on partitioning or on the order in which rows arrive, so reruns
and recomputed tasks agree. Equal records (found by two hashes, counted without
their texts) are counted before they are scattered (a record repeated by a third
of all rows is one pre-aggregated row) and every copy goes to a bucket of its own
draw. The copies of one text have doc_ids of their own and scatter like any other
records.

Defined cases: a NULL text has size 1 (no bytes, plus 1) and a NULL crc; NULL
doc_ids are ordinary records; an empty table gives empty shards.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import running_offsets
from armlens.session import ensure_checkpoint_dir

BUCKET_ROWS = 512
BUCKET_BYTES = 8_000_000
SHARDS = 16


def fisher_yates(n: Column, *seed: Column) -> Column:
    """A permutation of 0 .. n-1 (inside-out Fisher-Yates, seeded draws)."""
    none = F.array().cast("array<int>")

    def step(acc, i):
        j = F.pmod(F.xxhash64(*seed, i), (i + 1).cast("bigint")).cast("int")
        # place j's record moves to the end, i takes its place
        moved = F.concat(F.slice(acc, 1, j), F.array(i), F.slice(acc, j + 2, n), F.array(F.get(acc, j)))
        return F.when(j == i, F.concat(acc, F.array(i))).otherwise(moved)

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), none, step)).otherwise(none)


def bucket_count(records: DataFrame, bucket_rows: int, bucket_bytes: int) -> int:
    """As many buckets as keep each within both bounds on average."""
    held = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("bigint") for c in records.columns]
    total = records.select(sum(held[1:], held[0]).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    return max(1, -(-total["n"] // bucket_rows), -(-(total["b"] or 0) // bucket_bytes))


def shuffled_ranks(records: DataFrame, seed: int = 11, bucket_rows: int = BUCKET_ROWS,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``records`` with ``rank``: a seeded uniform permutation of 0 .. count-1.
    The name must be free."""
    names = records.columns
    buckets = bucket_count(records, bucket_rows, bucket_bytes)
    packed = records.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("record"))
    repeated = packed.select(F.xxhash64("record").alias("a"), F.xxhash64(F.lit(seed), "record").alias("b")).groupBy(
        "a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.isEmpty():
        copies = packed.withColumn("copy", F.lit(1).cast("bigint"))
    else:
        same = packed.groupBy("record").agg(F.count(F.lit(1)).alias("n"))
        copies = same.select("record", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
    # one hash for the bucket, another for the order in which the bucket is read
    bucket = F.pmod(F.xxhash64(F.lit(seed), "record", "copy"), F.lit(buckets).cast("bigint")).alias("bucket")
    offsets = running_offsets(copies.select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")),
                              "bucket", "n", "offset").select("bucket", "offset")
    seeded = copies.select(
        bucket, F.struct(F.xxhash64(F.lit(seed + 1), "record", "copy").alias("h"), "copy", "record").alias("r"))
    held = seeded.repartition("bucket").groupBy("bucket").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    mixed = held.select("bucket", "rs", fisher_yates(F.size("rs"), F.lit(seed + 2), F.col("bucket")).alias("order"))
    placed = mixed.join(offsets, "bucket").select(
        "offset", F.posexplode(F.transform(F.array("rs"), lambda rs: F.transform("order", lambda i: F.get(rs, i)))[0])
        .alias("place", "r"))
    return placed.select(*[F.col("r.record")[c].alias(c) for c in names], (F.col("offset") + F.col("place")).alias("rank"))


def _free(name: str, taken: list) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 11, shard_col: str = "shard",
                 slot_col: str = "slot") -> DataFrame:
    """Write whole rows of ``docs`` as ``shards`` parquet folders under ``path``,
    each file in shuffled order (``slot_col``), and return them as read back."""
    for c in (shard_col, slot_col):
        if _free(c, docs.columns) != c:
            raise ValueError(f"column {c} is taken")
    # positional names inside, so that no column of ``docs`` can clash
    inner = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    ranked = shuffled_ranks(inner, seed)
    placed = ranked.select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)],
        F.floor(F.col("rank") / shards).cast("bigint").alias(slot_col),
        F.pmod("rank", F.lit(shards)).cast("int").alias(shard_col))
    placed.sortWithinPartitions(shard_col, slot_col).write.partitionBy(shard_col).parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                  seed: int = 11) -> DataFrame:
    """Shards of whole rows of ``docs``, written to the shared checkpoint folder;
    per row read back from them: doc_id, size, text_crc32, shard, slot."""
    path = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/llm/shards-{uuid.uuid4().hex}"
    shard, slot = _free("shard", docs.columns), _free("slot", docs.columns)
    written = write_shards(docs, path, shards, seed, shard, slot)
    bytes_ = F.encode(F.col(text_col), "UTF-8")
    return written.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(bytes_), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(bytes_).alias("text_crc32"), F.col(shard).alias("shard"), F.col(slot).alias("slot"))
