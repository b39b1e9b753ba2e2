"""Paired Wilcoxon signed-rank test as a grouped Spark job (AGG-12, WIN-3/4, JN-14).

Semantics (two-sided, zero_method "wilcox", no continuity correction,
method "auto", NaN omitted):

* each arm's daily series is paired with the Control series of the same test,
  granularity and KPI by position (``pair_on="position"``: the i-th day of the
  arm, ordered by region, entity, test id, date) or by date (``"date"``);
  with positional pairing, arms of unequal length have no p-value;
* zero differences are dropped; |d| gets mid-ranks; W+ / W- are the rank sums;
* exact null distribution when there are at most 50 pairs, no zeros (and no
  ties unless ``ties_exact``); otherwise the normal approximation with the tie
  correction ``sigma^2 = (n(n+1)(2n+1) - sum(t^3 - t)/2) / 24``.

Shuffles: one window per arm, one window for mid-ranks, one aggregate. A proof
that no arm is long (``rows``) is needed for those windows; without it positions
and mid-ranks come from running totals over range partitions
(``operators.prefix``), so no task holds a whole arm.

The exact null distribution is a table: the probabilities of W+ for every sample
size, built by a recursion over arrays and joined on (n, W+). The normal tail is
an expression. No Python runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from armlens.operators.prefix import running_total
from armlens.plans.sizing import bounded_broadcast

ARM_KEYS = ("test_name", "granularity", "kpi", "variant")
LONG_ARM = 1_000_000  # values that one window task may hold


def null_distribution(spark: SparkSession, max_n: int) -> DataFrame:
    """(n, w, lower, upper): P(W+ <= w) and P(W+ >= w) under the null hypothesis, w = 0 .. n(n+1)/2, for
    n = 1 .. ``max_n``. Each rank enters with either sign: half the distribution stays, half moves up."""
    def add_rank(p, k):
        none = F.array_repeat(F.lit(0.0), k)
        return F.zip_with(F.concat(p, none), F.concat(none, p), lambda a, b: (a + b) / 2)
    sizes = spark.range(1, max_n + 1).select(F.col("id").cast("int").alias("n"))
    p = F.aggregate(F.sequence(F.lit(1), F.col("n")), F.array(F.lit(1.0)), add_rank)
    each = sizes.select("n", F.posexplode(p).alias("w", "p"))
    up = Window.partitionBy("n").orderBy("w").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("n").orderBy(F.desc("w")).rowsBetween(Window.unboundedPreceding, 0)
    return each.select(F.col("n").cast("long").alias("n"), F.col("w").cast("long").alias("w"),
                       F.sum("p").over(up).alias("lower"), F.sum("p").over(down).alias("upper"))


def erfc(x: Column) -> Column:
    """Complementary error function, x >= 0, to about 13 digits: below 2 by the series
    erf(x) = 2 / sqrt(pi) * exp(-x^2) * sum of 2^k x^(2k+1) / (2k+1)!!, above by the continued fraction
    exp(-x^2) / sqrt(pi) / (x + (1/2) / (x + (2/2) / (x + (3/2) / ...)))."""
    start = F.struct(x.alias("term"), x.alias("sum"))

    def add(s, k):
        term = s["term"] * 2 * x * x / (2 * k + 1)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, add, lambda s: s["sum"])
    fraction = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), x, lambda f, k: x + k / 2 / f)
    density = F.exp(-x * x) / math.sqrt(math.pi)
    return F.when(x < 2, 1 - 2 * density * series).otherwise(density / fraction)


def long_kpis(daily: DataFrame, kpis, keys, date_col: str) -> DataFrame:
    """Unpivot the KPI columns into (kpi, value); values as exact decimals so
    equal differences stay equal (ties) regardless of summation order."""
    return daily.unpivot(
        ids=[*keys, "granularity", "variant", date_col],
        values=[F.col(k).try_cast("decimal(38,9)").alias(k) for k in kpis],
        variableColumnName="kpi", valueColumnName="value")


def _number_windows(long: DataFrame, order) -> DataFrame:
    arm = Window.partitionBy(*ARM_KEYS)
    return long.withColumns({"_rn": F.row_number().over(arm.orderBy(*order)), "_n_arm": F.count(F.lit(1)).over(arm)})


def _number_ranges(long: DataFrame, order) -> DataFrame:
    numbered = running_total(long, ARM_KEYS, order, F.lit(1).cast("long"), "_rn").withColumn("_rn", F.col("_rn") + 1)
    sizes = long.groupBy(*ARM_KEYS).agg(F.count(F.lit(1)).alias("_n_arm"))
    return numbered.join(sizes, list(ARM_KEYS))


def _mid_ranks(ties: DataFrame, long_arms: bool) -> DataFrame:
    """``_before`` (smaller differences) for every distinct |d| of an arm with its count ``_t``."""
    if long_arms:
        return running_total(ties, ARM_KEYS, ["_abs"], F.col("_t"), "_before")
    smaller = Window.partitionBy(*ARM_KEYS).orderBy("_abs").rowsBetween(Window.unboundedPreceding, -1)
    return ties.withColumn("_before", F.coalesce(F.sum("_t").over(smaller), F.lit(0)))


def signed_rank_stats(long: DataFrame, control: str = "Control", pair_on: str = "position",
                      order_keys=("region", "entity_id", "test_id"), date_col: str = "created_date_utc",
                      rows: int | None = None) -> DataFrame:
    """Per (test_name, granularity, kpi, variant != control): arm lengths, pair
    count, zero count, n, W+, W-, tie term sum(t^3 - t). ``rows``: a proven bound
    on the values of any arm; up to ``LONG_ARM`` windows number them."""
    long_arms = rows is None or rows > LONG_ARM
    order = [*order_keys, date_col]
    # numbered and counted before missing values go: "omit" drops the pair, not the day
    s = _number_ranges(long, order) if long_arms else _number_windows(long, order)
    x = s.where(F.col("variant") != control)
    y = s.where(F.col("variant") == control).select(
        "test_name", "granularity", "kpi", *order_keys, date_col,
        F.col("_rn"), F.col("value").alias("_y"), F.col("_n_arm").alias("n_y"))
    if pair_on == "position":
        pairs = x.join(y.drop(*order_keys, date_col), ["test_name", "granularity", "kpi", "_rn"], "inner")
    else:
        pairs = x.join(y.drop("_rn", "n_y"), ["test_name", "granularity", "kpi", *order_keys, date_col], "inner")
        pairs = pairs.withColumn("n_y", F.col("_n_arm"))
    d = F.col("value") - F.col("_y")
    pairs = pairs.where(d.isNotNull()).select(*ARM_KEYS, F.col("_n_arm").alias("n_x"), "n_y", d.alias("d"))
    # equal |d| share their mid-rank: a row for each distinct one, however often it occurs
    ties = pairs.where(F.col("d") != 0).groupBy(*ARM_KEYS, F.abs("d").alias("_abs")).agg(
        F.count(F.lit(1)).alias("_t"), F.sum(F.when(F.col("d") > 0, 1).otherwise(0)).alias("_up"))
    nz = _mid_ranks(ties, long_arms).withColumn("_r", F.col("_before") + (F.col("_t") + 1) / 2.0)
    stats_nz = nz.groupBy(*ARM_KEYS).agg(
        F.sum("_t").alias("n"),
        F.sum(F.col("_r") * F.col("_up")).alias("w_plus"),
        F.sum(F.col("_r") * (F.col("_t") - F.col("_up"))).alias("w_minus"),
        F.sum(F.col("_t") * (F.col("_t") * F.col("_t") - 1)).cast("long").alias("tie_term"))
    stats_all = pairs.groupBy(*ARM_KEYS).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum(F.when(F.col("d") == 0, 1).otherwise(0)).cast("long").alias("n_zero"),
        F.max("n_x").alias("n_x"), F.max("n_y").alias("n_y"))
    out = stats_all.join(stats_nz, list(ARM_KEYS), "left").fillna({"n": 0, "w_plus": 0.0, "w_minus": 0.0,
                                                                   "tie_term": 0})
    return out.select(*ARM_KEYS, "n_x", "n_y", "n_pairs", "n_zero", F.col("n").cast("long").alias("n"),
                      "w_plus", "w_minus", "tie_term")


def add_p_values(stats: DataFrame, pair_on: str = "position", ties_exact: bool = False,
                 exact_max_n: int = 50) -> DataFrame:
    """p-value per statistics row; NULL where the reference raised (unequal
    arm lengths, all differences zero) or had nothing to test."""
    c = F.col
    testable = (c("n") > 0)
    if pair_on == "position":
        testable = testable & (c("n_x") == c("n_y"))
    exact = (c("n_pairs") <= exact_max_n) & (c("n_zero") == 0)
    if not ties_exact:
        exact = exact & (c("tie_term") == 0)
    z = F.abs(F.least("w_plus", "w_minus") - c("n") * (c("n") + 1) / 4.0) / F.sqrt(
        (c("n") * (c("n") + 1) * (2 * c("n") + 1) - c("tie_term") / 2.0) / 24.0)
    method = F.when(testable, F.when(exact, F.lit("exact")).otherwise(F.lit("approx")))
    tails = null_distribution(stats.sparkSession, exact_max_n).select(
        F.col("n").alias("_n"), F.col("w").alias("_w"), "lower", "upper")
    rows = exact_max_n * (exact_max_n + 1) * (exact_max_n + 2) // 6 + exact_max_n  # of that table
    w = F.floor("w_plus")  # a tied mid-rank sum is truncated, as the exact table is integral
    joined = stats.withColumn("method", method).join(
        bounded_broadcast(tails, bound=rows), (c("method") == "exact") & (c("n") == c("_n")) & (w == c("_w")), "left")
    centre = w == F.floor(c("n") * (c("n") + 1) / 4)
    p = F.when(centre, F.lit(1.0)).otherwise(F.least(F.lit(1.0), 2 * F.least("lower", "upper")))
    return joined.select(*stats.columns, "method", F.when(c("method") == "exact", p).when(
        c("method") == "approx", erfc(z / math.sqrt(2.0))).alias("pval"))
