"""AGG-12: signed-rank statistics and p-values (T12, exact vs normal branch)."""
import itertools
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from armlens.operators import wilcoxon as W


def exact_two_sided(n, w_plus):
    counts = brute_sums(n)
    w = int(w_plus)
    if w == n * (n + 1) // 2 // 2:
        return 1.0
    return min(1.0, 2 * min(sum(counts[:w + 1]), sum(counts[w:])) / 2 ** n)


def normal_two_sided(n, w_plus, w_minus, tie_term):
    z = (min(w_plus, w_minus) - n * (n + 1) / 4) / math.sqrt((n * (n + 1) * (2 * n + 1) - tie_term / 2) / 24)
    return math.erfc(abs(z) / math.sqrt(2))


def brute_sums(n):
    """Sign assignments of ranks 1..n by their sum, in whole numbers."""
    c = [1]
    for k in range(1, n + 1):
        c = [(c[i] if i < len(c) else 0) + (c[i - k] if i >= k else 0) for i in range(len(c) + k)]
    return c


def brute_counts(n):
    total = n * (n + 1) // 2
    c = [0] * (total + 1)
    for signs in itertools.product((0, 1), repeat=n):
        c[sum(r for r, s in zip(range(1, n + 1), signs) if s)] += 1
    return c


def test_null_distribution(spark):
    got = {}
    for r in W.null_distribution(spark, 60).collect():
        got.setdefault(r.n, {})[r.w] = (r.lower, r.upper)
    for n in range(1, 61):
        counts = brute_counts(n) if n < 13 else brute_sums(n)
        assert counts == brute_sums(n) and sorted(got[n]) == list(range(len(counts)))
        low = high = 0
        for w, c in enumerate(counts):
            low += c
            assert got[n][w][0] == pytest.approx(low / 2 ** n, rel=1e-12)
        for w in range(len(counts) - 1, -1, -1):
            high += counts[w]
            assert got[n][w][1] == pytest.approx(high / 2 ** n, rel=1e-12)


def test_erfc(spark):
    xs = [k / 40 for k in range(0, 400)] + [1.9999999, 2.0000001, 15.0, 26.0, 40.0]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", W.erfc(F.col("x")).alias("y")).collect():
        assert r.y == pytest.approx(math.erfc(r.x), rel=1e-12, abs=1e-300)


def long_frame(spark, arms):
    """arms: {variant: [values by day]} for one test / granularity / kpi."""
    rows = []
    for v, vals in arms.items():
        for i, x in enumerate(vals):
            rows.append(("R", "E", 1, "t", "Experiment", "k", v, f"2024-01-{i + 1:02d}",
                         None if x is None else Decimal(str(x))))
    df = spark.createDataFrame(rows, "region string, entity_id string, test_id bigint, test_name string, "
                                     "granularity string, kpi string, variant string, d string, value decimal(38,9)")
    return df.withColumn("created_date_utc", F.to_date("d")).drop("d")


def pval(spark, arms, **kw):
    stats = W.signed_rank_stats(long_frame(spark, arms))
    out = W.add_p_values(stats, **kw).collect()
    return out[0] if out else None


def test_five_positive_pairs(spark):
    r = pval(spark, {"Control": [0, 0, 0, 0, 0], "V1": [1, 2, 3, 4, 5]})
    assert (r.n, r.w_plus, r.w_minus, r.method) == (5, 15.0, 0.0, "exact")
    assert r.pval == pytest.approx(0.0625)


def test_unequal_lengths_give_null(spark):
    r = pval(spark, {"Control": [1, 2], "V1": [3, 4, 5]})  # T12
    assert r.pval is None and r.method is None


def test_all_equal_gives_null(spark):
    r = pval(spark, {"Control": [1, 2, 3], "V1": [1, 2, 3]})
    assert r.n == 0 and r.pval is None


def test_zero_difference_switches_to_normal(spark):
    r = pval(spark, {"Control": [0, 0, 0, 0], "V1": [0, 1, 2, 3]})
    assert (r.n_pairs, r.n_zero, r.n, r.method) == (4, 1, 3, "approx")
    assert r.pval == pytest.approx(normal_two_sided(3, 6.0, 0.0, 0.0))


def test_ties_midrank_and_tie_term(spark):
    r = pval(spark, {"Control": [0, 0, 0, 0], "V1": [1, -1, 2, 2]})
    # |d| = 1,1,2,2 -> mid-ranks 1.5,1.5,3.5,3.5 ; W+ = 1.5+3.5+3.5
    assert (r.w_plus, r.w_minus, r.tie_term) == (8.5, 1.5, 12)
    assert r.method == "approx"
    r2 = pval(spark, {"Control": [0, 0, 0, 0], "V1": [1, -1, 2, 2]}, ties_exact=True)
    assert r2.method == "exact" and r2.pval == pytest.approx(exact_two_sided(4, 8.0))


def test_swap_arms_same_two_sided_p(spark):
    x, y = [3.1, 2.0, 5.5, 1.2, 9.9, 4.4], [1.0, 2.5, 3.0, 0.2, 7.7, 4.0]
    a = pval(spark, {"Control": y, "V1": x})
    b = pval(spark, {"Control": x, "V1": y})
    assert a.pval == pytest.approx(b.pval)
    assert 0.0 <= a.pval <= 1.0


def test_pairs_by_position_across_dates(spark):
    # positional pairing ignores which date a value belongs to
    stats = W.signed_rank_stats(long_frame(spark, {"Control": [1, 2, 3], "V1": [2, 3, 4]}))
    assert stats.first().n == 3 and stats.first().w_plus == 6.0


def stats_frame(spark, rows):
    return spark.createDataFrame([("t", "g", "k", f"v{i}", r[0], r[0], r[0], 0, *r) for i, r in enumerate(rows)],
                                 "test_name string, granularity string, kpi string, variant string, n_x long, n_y long, "
                                 "n_pairs long, n_zero long, n long, w_plus double, w_minus double, tie_term long")


def test_p_values_match_whole_number_sums_and_run_without_python(spark):
    rows = [(n, float(w), float(n * (n + 1) / 2 - w), 0) for n in (1, 3, 8, 20, 50) for w in (0, 1, n, n * (n + 1) // 4)]
    rows += [(n, w + 0.5, n * (n + 1) / 2 - w - 0.5, 6) for n in (5, 30, 80, 100_000) for w in (2, 10)]
    rows += [(51, 600.0, 726.0, 0), (10 ** 6, 2.5e11, 2.5000025e11, 0)]
    out = W.add_p_values(stats_frame(spark, rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    for r in out.collect():
        exact = r.n <= 50 and r.tie_term == 0
        assert r.method == ("exact" if exact else "approx")
        want = exact_two_sided(r.n, r.w_plus) if exact else normal_two_sided(r.n, r.w_plus, r.w_minus, r.tie_term)
        assert r.pval == pytest.approx(want, rel=1e-11, abs=1e-300)


def arms(spark, n, seed=0):
    """Two arms and a control of ``n`` values with many ties, zeros and gaps."""
    i = F.col("id")
    def value(k):
        v = (F.pmod(F.xxhash64(i, F.lit(k + seed)), F.lit(97)) - F.lit(40 + k)).cast("decimal(38,9)") / 4
        return F.when(F.pmod(F.xxhash64(i, F.lit(50 + k)), F.lit(29)) == 0, F.lit(None)).otherwise(v).cast("decimal(38,9)")
    parts = None
    for k, v in enumerate(("Control", "V1", "V2")):
        part = spark.range(n + (k == 2)).select(
            F.lit("t").alias("test_name"), F.lit("g").alias("granularity"), F.lit("k").alias("kpi"), F.lit(v).alias("variant"),
            i.alias("place"), F.to_date(F.lit("2024-01-01")).alias("day"), value(k).alias("value"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def test_ranges_equal_windows(spark):
    for n in (0, 1, 7, 500):
        long = arms(spark, n)
        kw = {"order_keys": ("place",), "date_col": "day"}
        a = W.signed_rank_stats(long, rows=1000, **kw).collect()
        b = W.signed_rank_stats(long, **kw).collect()
        assert sorted(map(str, a)) == sorted(map(str, b))
        a = W.signed_rank_stats(long, rows=1000, pair_on="date", **kw).collect()
        b = W.signed_rank_stats(long, pair_on="date", **kw).collect()
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_arms_of_millions_of_values_over_many_partitions(spark):
    from armlens.operators.prefix import running_total
    n = 1_000_000
    long = arms(spark, n)
    kw = {"order_keys": ("place",), "date_col": "day"}
    a = W.signed_rank_stats(long, rows=1, **kw).collect()
    b = W.signed_rank_stats(long, **kw).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and {r.n_x for r in b} == {n, n + 1}
    # one group over many parts, no part above its share
    dealt = running_total(long.where("variant = 'V1'"), ["variant"], ["place"], F.lit(1).cast("long"), "at", partitions=16)
    assert dealt.where("at <> place").count() == 0
    assert "rangepartitioning" not in dealt._jdf.queryExecution().executedPlan().toString()  # written once
    sizes = [r[1] for r in dealt.groupBy("_part" if "_part" in dealt.columns else F.floor(F.col("at") / (n / 16))).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * n / 16


def test_running_total_of_several_groups(spark):
    from armlens.operators.prefix import running_total
    rows = [(g, o, v) for g in ("a", "b", None) for o in range(40) for v in (o % 3, 5)]
    df = spark.createDataFrame(rows, "g string, o int, v long").repartition(5)
    got = running_total(df.groupBy("g", "o").agg(F.sum("v").alias("v")), ["g"], ["o"], F.col("v"), "before", partitions=7).collect()
    assert len(got) == 120
    for r in got:
        assert r.before == sum(o % 3 + 5 for o in range(r.o))


def test_pair_on_date_uses_shared_dates(spark):
    long = long_frame(spark, {"Control": [1, 2, 3, 4, 5, 6], "V1": [3, 5, 7, 9, 11]})  # V1 lacks day 6
    pos = W.add_p_values(W.signed_rank_stats(long), pair_on="position").first()
    assert pos.pval is None  # unequal arms (T12)
    by_date = W.add_p_values(W.signed_rank_stats(long, pair_on="date"), pair_on="date").first()
    # days 1..5 pair: d = 2, 3, 4, 5, 6 -> all positive, exact two-sided p = 2 / 2^5
    assert (by_date.n, by_date.w_plus, by_date.method) == (5, 15.0, "exact")
    assert by_date.pval == pytest.approx(0.0625)


def test_missing_value_drops_its_pair_only(spark):
    # numbered before missing values go: day 2 loses its pair, later days keep theirs
    r = pval(spark, {"Control": [0, 0, 0, 0], "V1": [1, None, 3, 4]})
    assert (r.n_x, r.n_y, r.n_pairs, r.n, r.w_plus) == (4, 4, 3, 3, 6.0)
