"""Mixing sources to target weights by a splitting tree (operator 1, DataFrame functions only).

Sources in code-point order (NULL last) weigh 5, 2, 1, repeating, and share all
words of the corpus. A target stops at ``max_epochs`` times its source's size;
what it leaves is shared again by weight until no target is above.

* A source is cut into blocks by a seeded hash of its documents (about
  ``BLOCK_ROWS`` each), and its blocks are permuted by a seeded hash. A target
  of q whole sizes and a rest takes every block q times, then permuted blocks
  while they fit the rest, and of the next block each permuted document that
  still fits, and the smallest of the others if that comes nearer. So the words
  taken miss the target by half a document at most.
* These draws are exact quotas of blocks for each source. A binary tree splits
  them among the output shards: at every node the left half's share of each
  source is a multivariate hypergeometric draw, made by inverting univariate
  hypergeometric distributions with seeded uniforms. A shard then holds, of each
  source, a run of its permuted draws, disjoint from every other shard's.
* Inside a shard, documents are ordered by a seeded hash (``place``).

Sums along the blocks of one source run in two levels (``_running``), so a
source with a third of all rows is never gathered in one task; its documents
meet again only within their block. Sources are as many as their names; their
totals, targets and quotas are small tables. Same input, same mix.

Defined cases: a NULL or blank text has size 0 and takes 0 words; rows that
agree in id, source and size are drawn alike; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from armlens.llm.common import staged, words

WEIGHTS = (5.0, 2.0, 1.0)  # by the rank of the source's name, repeating
BLOCK_ROWS = 256
SHARDS = 16


def _uniform(*keys) -> Column:
    """Seeded uniform in (0, 1) from key columns."""
    return (F.pmod(F.xxhash64(*keys), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, max_epochs: int = 3) -> DataFrame:
    """source, rows, source_size, weight, target: the shared words, capped and reshared.

    Fill level: with sources ordered by cap / weight, the capped ones are a
    prefix, and the level of the rest is (all words - their caps) / rest weight."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_name = W.orderBy(F.col("source").isNull(), "source")  # one row a source
    cap = F.col("source_size") * float(max_epochs)
    ranked = totals.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("source_no") % len(WEIGHTS)).cast("int")))
    order = W.orderBy(cap / F.col("weight"), "source_no")
    upto = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(upto), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))))
    leveled = ranked.withColumn("level", level)
    # the first source in this order whose cap lies above the level fixes the level for all after it
    open_ = F.when(cap >= F.col("level") * F.col("weight"), F.col("level"))
    final = F.first(open_, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return leveled.select(
        "source", "source_no", "rows", "source_size", "weight",
        F.least(cap, F.coalesce(final, F.lit(0.0)) * F.col("weight")).alias("target"))


def _running(df: DataFrame, keys: list, order: list, value: str, out: str, fan: Column) -> DataFrame:
    """``out``: sum of ``value`` over the rows before, per ``keys`` in ``order``;
    two levels, ``fan`` being a coarse key that ``order`` starts with."""
    inside = W.partitionBy(*keys, "_fan").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("_fan", fan)
    totals = df.groupBy(*keys, "_fan").agg(F.sum(value).alias("_v"))
    before = W.partitionBy(*keys).orderBy("_fan").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*keys, "_fan", F.coalesce(F.sum("_v").over(before), F.lit(0)).alias("_base"))
    return (df.join(totals, [*keys, "_fan"])
            .withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_base")).drop("_fan", "_base"))


def _hypergeometric(left: Column, total: Column, good: Column, u: Column) -> Column:
    """Number of the ``good`` among ``left`` draws without replacement from
    ``total``: the inverse distribution at ``u``. Weights follow the ratio
    recurrence outward from the mode, ten standard deviations each way."""
    low = F.greatest(F.lit(0), left + good - total).cast("long")
    high = F.least(left, good).cast("long")
    mode = F.least(high, F.greatest(low, F.floor(
        (left + 1).cast("double") * (good + 1).cast("double") / (total + 2).cast("double")).cast("long")))
    share = good.cast("double") / F.greatest(total, F.lit(1))
    reach = F.ceil(10 * F.sqrt(left * share * (1 - share) + 1) + 10).cast("long")

    def ratio(k):  # weight(k + 1) / weight(k)
        return ((good - k).cast("double") * (left - k).cast("double")
                / ((k + 1).cast("double") * (total - good - left + k + 1).cast("double")))

    def walk(first, last, step, factor):
        empty = F.struct(F.array(F.struct(mode.alias("k"), F.lit(1.0).alias("w"))).alias("a"), F.lit(1.0).alias("w"))
        ks = F.when((last - first) * step >= 0, F.sequence(first, last, F.lit(step).cast("long"))).otherwise(
            F.array().cast("array<bigint>"))

        def add(acc, k):
            w = acc["w"] * factor(k)
            return F.struct(F.concat(acc["a"], F.array(F.struct(k.alias("k"), w.alias("w")))).alias("a"), w.alias("w"))
        return F.aggregate(ks, empty, add)["a"]

    up = walk(mode + 1, F.least(high, mode + reach), 1, lambda k: ratio(k - 1))
    down = walk(mode - 1, F.greatest(low, mode - reach), -1, lambda k: 1 / ratio(k))
    bins = F.concat(F.reverse(F.slice(down, 2, 1 << 30)), up)

    def pick(all_bins):
        goal = u * F.aggregate(all_bins, F.lit(0.0), lambda s, x: s + x["w"])
        start = F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("long").alias("k"))
        return F.aggregate(all_bins, start, lambda a, x: F.struct(
            (a["s"] + x["w"]).alias("s"),
            F.coalesce(a["k"], F.when(a["s"] + x["w"] >= goal, x["k"])).alias("k")))["k"]

    return F.coalesce(F.transform(F.array(bins), pick)[0], mode)


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, starts): for every source the first draw of each shard, from
    ``quotas`` (source_no, draws). One row per tree node holds the node's quota
    of every source; each level replaces a node by its two halves."""
    node = quotas.agg(F.sort_array(F.collect_list(F.struct("source_no", F.col("draws").alias("n")))).alias("qs")).select(
        F.lit(0).alias("first"), F.lit(shards).alias("width"), "qs")
    while shards > 1:
        total = F.aggregate("qs", F.lit(0).cast("long"), lambda s, q: s + q["n"])
        half = F.floor(F.col("width") / 2).cast("int")
        cut = node.select("first", "width", "qs", half.alias("half"), total.alias("total"), F.when(
            F.col("width") > 1, F.round(total * half / F.col("width")).cast("long")).otherwise(total).alias("left"))
        start = F.struct(F.col("total").alias("t"), F.col("left").alias("l"), F.array().cast("array<bigint>").alias("xs"))

        def split(acc, q):
            u = _uniform(F.lit(seed), F.col("first"), F.col("width"), q["source_no"])
            x = F.when(F.col("width") <= 1, q["n"]).otherwise(_hypergeometric(acc["l"], acc["t"], q["n"], u))
            return F.struct((acc["t"] - q["n"]).alias("t"), (acc["l"] - x).alias("l"),
                            F.concat(acc["xs"], F.array(x)).alias("xs"))

        cut = cut.withColumn("xs", F.aggregate("qs", start, split)["xs"])

        def side(left):
            return F.zip_with("qs", "xs", lambda q, x: F.struct(
                q["source_no"].alias("source_no"), (x if left else q["n"] - x).alias("n")))
        halves = F.array(F.struct(F.col("first"), F.when(F.col("width") > 1, F.col("half")).otherwise(F.col("width")).alias("width"),
                                  side(True).alias("qs")),
                         F.struct((F.col("first") + F.col("half")).alias("first"),
                                  F.when(F.col("width") > 1, F.col("width") - F.col("half")).otherwise(0).alias("width"),
                                  side(False).alias("qs")))
        node = cut.select(F.explode(halves).alias("h")).select("h.*").filter("width > 0")
        shards = -(-shards // 2)
    flat = node.select("first", F.explode("qs").alias("q")).select("first", "q.source_no", "q.n")
    before = W.partitionBy("source_no").orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    flat = flat.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return flat.groupBy("source_no").agg(F.sort_array(F.collect_list(F.struct("first", "start"))).alias("starts"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        shards: int = SHARDS, seed: int = 7, max_epochs: int = 3) -> DataFrame:
    """Per row of ``docs``: id, size, source, source_size, target, taken, and
    ``draws``, the shards that take it, one entry for each copy."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.size(words(F.col(text_col))).cast("long").alias("size"))
    sized = staged(rows.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-sizes")
    each = sized.select("source", (F.col("size") * F.col("copies")).alias("size"))
    targets = staged(source_targets(each, max_epochs), "mix-targets")  # one row a source
    target = targets.select(F.col("source").alias("s"), "source_no", "rows", "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    # blocks of a source: seeded hash classes of its documents
    near = F.col("source").eqNullSafe(F.col("s"))
    placed = staged(sized.join(target.select("s", "source_no", "rows"), near).select(
        "id", "source", "size", "copies", "source_no", F.pmod(
            F.xxhash64(F.lit(seed), "id", "size"), F.ceil(F.col("rows") / BLOCK_ROWS)).alias("block")), "mix-placed")
    blocks = placed.groupBy("source_no", "block").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    shuffled = blocks.withColumn("rank", F.xxhash64(F.lit(seed + 1), "source_no", "block"))
    blocks = _running(shuffled, ["source_no"], ["rank", "block"], "words", "before",
                      F.shiftright("rank", 52)).withColumn("one", F.lit(1).cast("long"))
    blocks = _running(blocks, ["source_no"], ["rank", "block"], "one", "at", F.shiftright("rank", 52))
    blocks = staged(blocks.join(target.select("source_no", "source_size", "target"), "source_no").withColumn(
        "whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn(
        "more", (F.col("before") < F.col("rest")) & (F.col("words") > 0)), "mix-blocks")
    # draws of a source: its blocks in permuted order, again and again; the last round stops at the rest
    counts = blocks.groupBy("source_no").agg(
        F.count(F.lit(1)).alias("blocks"), F.max("whole").alias("whole"),
        F.sum(F.col("more").cast("long")).alias("more"))
    quotas = counts.select("source_no", (F.col("blocks") * F.col("whole") + F.col("more")).alias("draws"), "blocks")
    # one row a source, written: the tree's long expressions are planned once, not again with every join below
    starts = staged(shard_quotas(staged(quotas, "mix-quotas"), shards, seed).join(
        quotas.select("source_no", "blocks"), "source_no"), "mix-starts")
    rounds = F.transform(F.sequence(F.lit(0), F.lit(max_epochs)), lambda r: r.cast("long") * F.col("blocks") + F.col("at"))
    shard = F.transform(rounds, lambda d: F.size(F.filter("starts", lambda s: s["start"] <= d)) - 1)
    drawn = staged(blocks.join(starts, "source_no").select(
        "source_no", "block", "words", "whole", "more", (F.col("rest") - F.col("before")).alias("left"),
        # the shard whose run of draws holds the draw: the last one that starts at or before it and is not empty
        F.transform(shard, lambda i: F.get("starts", i)["first"]).alias("shard_of")), "mix-drawn")
    # the one block of a source that only partly fits its rest: its permuted documents, each taken if it still fits
    amount = F.col("size") * F.col("copies")
    key = F.struct(F.xxhash64(F.lit(seed + 2), "id", "size").alias("h"), "id", "size")
    partly = (drawn.filter(F.col("more") & (F.col("words") > F.col("left")))
              .select("source_no", "block", "left"))
    lists = (placed.filter("size > 0").join(partly, ["source_no", "block"]).groupBy("source_no", "block", "left")
             .agg(F.sort_array(F.collect_list(F.struct(key.alias("key"), amount.alias("n")))).alias("ds")))
    start = F.struct(F.col("left").alias("left"), F.array().cast(lists.schema["ds"].dataType).alias("got"))

    def fit(acc, d):
        fits = d["n"] <= acc["left"]
        return F.struct(F.when(fits, acc["left"] - d["n"]).otherwise(acc["left"]).alias("left"),
                        F.when(fits, F.concat(acc["got"], F.array(d))).otherwise(acc["got"]).alias("got"))

    def nearest(acc):
        # of the others, the smallest goes in too if that comes nearer to the rest than leaving it out
        other = F.filter("ds", lambda d: ~F.array_contains(acc["got"], d))
        least = F.array_min(F.transform(other, lambda d: F.struct(d["n"].alias("n"), d["key"].alias("key"))))
        return F.when(least["n"] < 2 * acc["left"], F.concat(acc["got"]["key"], F.array(least["key"]))).otherwise(acc["got"]["key"])

    filled = F.transform(F.array(F.aggregate("ds", start, fit)), nearest)[0]
    lists = lists.select("source_no", "block", filled.alias("got"))
    drawn = drawn.join(lists, ["source_no", "block"], "left")
    wholly = F.col("words") <= F.col("left")
    docs_drawn = placed.join(drawn, ["source_no", "block"]).withColumn(
        "extra", F.col("more") & (F.col("size") > 0) & (wholly | F.coalesce(F.array_contains("got", key), F.lit(False))))
    times = F.when(F.col("size") > 0, F.col("whole")).otherwise(0).cast("int")
    draws = F.concat(F.slice("shard_of", F.lit(1), times), F.when(
        F.col("extra"), F.slice("shard_of", F.col("whole").cast("int") + 1, 1)).otherwise(F.array().cast("array<int>")))
    out = docs_drawn.select("id", "size", "source", "source_no", "copies", draws.alias("draws"))
    out = out.join(target.select("source_no", "source_size", "target"), "source_no")
    return out.select("id", "size", "source", "source_size", "target",
                      (F.col("size") * F.size("draws")).alias("taken"), "draws",
                      F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    shards: int = SHARDS, seed: int = 7, max_epochs: int = 3) -> DataFrame:
    """The mix itself: rows of ``docs`` packed in ``row``, once for each draw,
    with ``shard`` and ``place`` (a seeded order inside the shard)."""
    size = F.size(words(F.col(text_col))).cast("long")
    full = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("fid"), F.col(source_col).alias("fsource"),
                       size.alias("fsize"))
    plan = mix(docs, id_col, source_col, text_col, shards, seed, max_epochs).filter(F.size("draws") > 0)
    plan = plan.select("id", "source", "size", "draws").dropDuplicates(["id", "source", "size"])
    same = (F.col("fid").eqNullSafe(F.col("id")) & F.col("fsource").eqNullSafe(F.col("source"))
            & (F.col("fsize") == F.col("size")))
    drawn = full.join(plan, same).select("row", "id", F.posexplode("draws").alias("round", "shard"))
    return drawn.select("row", "shard", F.xxhash64(F.lit(seed + 3), "id", "round").alias("place"))
