"""Quality rules by a hashed n-gram likelihood ratio (operator 6, DataFrame functions only).

Two multinomials over ``BUCKETS`` hashed words and word pairs: the trusted one
counts every document that ``labels`` marks with quality 1, the raw one every
document. A document's score is the sum of ``log(trusted / raw)`` over its
n-grams divided by their number; it is kept when the score reaches
``min_score`` and it passes the base rules (enough words, few words inside
five-word windows that repeat in the text).

Counting reads all whole texts and pre-aggregates to at most ``BUCKETS`` rows a
task. For the trusted counts a text is reduced to its buckets, two bytes each,
before it meets the labels in a shuffle, at every size of the input. The table of log ratios (``BUCKETS`` numbers, a fixed size) goes into the
scoring expression as a literal. Everything runs in expressions over the words
of one row; a repeated window is found by sorting the row's window hashes
(64 bit), and only in texts that repeat one.

Defined cases: NULL, empty and blank texts have no words, fail the base rules
and score 0; a document with several label rows is trusted if all of them are 1;
without a trusted document every score is 0 and only the base rules decide;
repeated rows score alike; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import staged, words

BUCKETS = 1 << 16
PRIOR = 4.0
WINDOW = 5
SYMBOLS = r"([#*$%&|<>])"  # fixed value of the base rule


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _pairs(h: Column) -> Column:
    return F.when(F.size(h) > 1, F.transform(
        F.sequence(F.lit(0), F.size(h) - 2), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)))).otherwise(
        F.array().cast("array<bigint>"))


def n_grams(h: Column) -> Column:
    """Buckets of the words and word pairs of a row, from its word hashes."""
    return F.transform(F.concat(h, _pairs(h)), lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int"))


def repeated_words(h: Column) -> Column:
    """Words inside a ``WINDOW``-word window that occurs at least twice in the row."""
    windows = F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(win):
        in_order = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        again = bound(in_order, lambda s: F.filter(s, lambda w, k: (F.get(s, k - 1)["x"] == w["x"])
                                                   | (F.get(s, k + 1)["x"] == w["x"])))
        starts = F.sort_array(F.transform(again, lambda w: w["i"]))
        widths = bound(starts, lambda s: F.transform(
            s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)))))
        total = F.aggregate(widths, F.lit(0), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(total)

    return bound(windows, covered)


def base_columns(text: Column, ws: Column, h: Column) -> dict:
    """The base features of the rules."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(ws).cast("bigint"),
        "word_chars": F.length(F.array_join(ws, "")).cast("bigint"),
        "n_symbols": F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("bigint"),
        "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeated_words(h).cast("bigint"),
    }


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = own.select("doc_id", "text", words(F.col("text")).alias("ws"))
    return split.select("doc_id", "text", "ws", F.transform("ws", lambda w: F.xxhash64(w)).alias("h"))


def bucket_counts(grams: DataFrame, name: str) -> DataFrame:
    """How often each bucket occurs in the arrays ``buckets``. From a plain explode the optimizer derives
    ``size(buckets) > 0`` and pushes it below the hashing, which would then hash the whole text anew for
    every word; the outer form derives nothing."""
    each = grams.select(F.explode_outer("buckets").alias("bucket")).filter("bucket is not null")
    return each.groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list:
    """``log(trusted / raw)`` of every bucket; ``trusted``: distinct doc_id. Trusted
    counts and those expected from the raw share get ``PRIOR`` counts each, so a
    bucket that was hardly seen says nothing."""
    grams = _hashed(docs, id_col, text_col).select("doc_id", n_grams(F.col("h")).alias("buckets"))
    raw = bucket_counts(grams, "raw")
    # BUCKETS values fit two bytes, shifted
    half = BUCKETS // 2
    small = grams.filter("doc_id is not null").select(
        "doc_id", F.transform("buckets", lambda x: (x - half).cast("smallint")).alias("buckets"))
    good = bucket_counts(small.join(trusted.select("doc_id").hint("merge"), "doc_id"), "good")
    good = good.withColumn("bucket", F.col("bucket").cast("int") + half)
    counts = raw.join(good, "bucket", "left").select("bucket", "raw", F.coalesce("good", F.lit(0)).alias("good"))
    counts = staged(counts, "quality-counts")  # at most BUCKETS rows
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    sums = total.first()
    if not sums["good"]:
        return [0.0] * BUCKETS
    share = sums["good"] / sums["raw"]
    rows = counts.select("bucket", F.log((F.col("good") + PRIOR) / (F.col("raw") * share + PRIOR)).alias("r")).collect()
    table = [0.0] * BUCKETS
    for bucket, r in rows:
        table[bucket] = r
    return table


def score_documents(docs: DataFrame, ratios: list, id_col: str = "doc_id", text_col: str = "text",
                    min_score: float = -0.15) -> DataFrame:
    """Per row of ``docs``: doc_id, base features, base_failed, score, kept."""
    # one literal after constant folding: BUCKETS doubles
    table = F.split(F.lit(",".join(f"{r:.7g}" for r in ratios)), ",").cast("array<double>")
    rows = _hashed(docs, id_col, text_col)
    grams = n_grams(F.col("h"))
    total = F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(table, b))
    scored = rows.select("doc_id", *[c.alias(n) for n, c in base_columns(F.col("text"), F.col("ws"), F.col("h")).items()],
                         (total / F.greatest(F.lit(1), 2 * F.size("h") - 1)).alias("score"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= min_score))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    return (labels.filter(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.min(quality_col).alias("q")).filter("q >= 1").select("doc_id"))
