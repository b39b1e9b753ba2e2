"""Joins on keys that may be hot (JN-6, JN-15).

``split_join`` deals the left rows into three parts by their key:

* rows with a NULL in the key match nothing and never shuffle: they are united
  with the result (outer) or dropped (inner, semi);
* hot keys, found by one pass of a mergeable frequent-items sketch over key
  hashes, meet their few right rows by broadcast, behind the measured size of
  those rows, so the left rows stay where they are. If a hot key has too many
  right rows to broadcast, its left rows are dealt to ``salts`` shares and its
  right rows are copied to each share;
* all other rows shuffle on the key. None of those keys holds more than about
  half a fair share of a shuffle partition, so no task stands out.

The result equals the plain join. The left side is read once for the sketch and
once a part: it is written as a table first unless it is one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, known_size

HOW = ("inner", "left", "left_semi", "left_anti")


def _all_known(keys) -> F.Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def hot_keys(df: DataFrame, keys, tasks: int | None = None) -> list[int]:
    """``xxhash64`` of the keys that hold more than 1 / (2 * tasks) of the rows with a whole key (``tasks``:
    the shuffle partitions). The sketch tracks 16 times as many items as there can be such keys, so its
    error stays far below the threshold; it may add a key just under it."""
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = 2 * tasks
    tracked = 1 << max(9, (16 * most - 1).bit_length())
    found = (df.where(_all_known(keys)).select(F.xxhash64(*keys).alias("h"))
             .agg(F.expr(f"approx_top_k(h, {most}, {min(tracked, 1_000_000)})").alias("top"),
                  F.count(F.lit(1)).alias("rows")).first())  # at most ``most`` pairs
    return sorted(r["item"] for r in found["top"] if r["count"] * most > found["rows"])


def split_join(left: DataFrame, right: DataFrame, keys, how: str = "left", tasks: int | None = None, salts: int = 32,
               max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``left.join(right, keys, how)``; columns: those of ``left``, then the others of ``right``."""
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    keys = list(keys)
    left = left if known_size(left) is not None else cut_lineage(left, "split_left", as_table=True)
    both = how in ("inner", "left")
    order = [*left.columns, *[c for c in right.columns if c not in keys]] if both else left.columns
    hot = hot_keys(left, keys, tasks)
    whole, is_hot = _all_known(keys), F.xxhash64(*keys).isin(hot) if hot else F.lit(False)
    right = right.where(_all_known(keys))
    parts = [left.where(whole & ~is_hot).join(right.where(~is_hot), keys, how).select(*order)]
    if hot:
        parts.append(_hot_join(left.where(whole & is_hot), right.where(is_hot), keys, how, salts, max_rows, max_bytes).select(*order))
    if how in ("left", "left_anti"):
        types = {f.name: f.dataType for f in right.schema.fields}
        empty = [F.lit(None).cast(types[c]).alias(c) for c in order if c not in left.columns]
        parts.append(left.where(~whole).select(*left.columns, *empty))
    return reduce(DataFrame.unionByName, parts)


def _hot_join(left: DataFrame, right: DataFrame, keys, how: str, salts: int, max_rows: int, max_bytes: int) -> DataFrame:
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()  # as few rows as there are hot keys
    right = cut_lineage(right, "hot_keys")
    if known_size(right).fits(max_rows, max_bytes):
        return left.join(F.broadcast(right), keys, how)
    # too many right rows for the hot keys: deal the left rows, copy the right ones
    share = F.pmod(F.xxhash64(*left.columns), F.lit(salts))
    if any(f.dataType.typeName() in ("map", "variant") for f in left.schema.fields):
        share = F.floor(F.rand(7) * salts).cast("long")
    copies = right.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return left.withColumn("_share", share).join(copies, [*keys, "_share"], how).drop("_share")


def lookup_join(left: DataFrame, right: DataFrame, keys, how: str = "left", max_rows: int = DEFAULT_MAX_ROWS,
                max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Join with a table whose size is known: broadcast it if it fits, else ``split_join``."""
    size = known_size(right)
    if size is not None and size.fits(max_rows, max_bytes):
        return left.join(F.broadcast(right), list(keys), how)
    return split_join(left, right, keys, how, max_rows=max_rows, max_bytes=max_bytes)
