"""JN-6 / JN-15: joins on hot and NULL keys equal the plain join and stay even."""
import statistics

import pytest
from pyspark.sql import functions as F

from armlens.operators import sessions as se
from armlens.operators import skew
from armlens.plans.materialize import cut_lineage


def left_rows(spark, n=30_000):
    """A third of the rows on one key, a seventh without a key, the others spread."""
    i = F.col("id")
    df = spark.range(0, n, 1, 8).select(
        i, F.when(i % 3 == 0, 1).when(i % 7 == 0, None).otherwise(i % 5000).cast("long").alias("a"),
        F.when(i % 11 == 1, None).otherwise(F.lit("x")).alias("b"), F.array(i).alias("v"))
    return cut_lineage(df, "skew_left", as_table=True)


def right_rows(spark, copies=1):
    return spark.range(6000).where("id % 4 != 2").select(
        F.col("id").alias("a"), F.lit("x").alias("b"), F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("c")).union(
        spark.createDataFrame([(None, "x", -1), (5, None, -2)], "a long, b string, c int"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", skew.HOW)
@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_equals_the_plain_join(spark, how, max_rows):
    left, right = left_rows(spark), right_rows(spark, 2)
    got = skew.split_join(left, right, ["a", "b"], how, tasks=8, salts=5, max_rows=max_rows)
    want = left.join(right, ["a", "b"], how).select(*got.columns)
    assert rows(got) == rows(want)
    if max_rows == 0 and how == "inner":
        assert "_share" in got._jdf.queryExecution().analyzed().toString()


def test_hot_keys_are_found(spark):
    left = left_rows(spark)
    h = left.where("a = 1 and b is not null").select(F.xxhash64("a", "b")).first()[0]
    assert skew.hot_keys(left, ["a", "b"], tasks=8) == [h]
    assert skew.hot_keys(left.where("a > 1"), ["a", "b"], tasks=8) == []
    assert skew.hot_keys(left.where("false"), ["a", "b"], tasks=8) == []


def test_edges(spark):
    left, right = left_rows(spark, 50), right_rows(spark)
    right = right.select("a", "c")
    empty = skew.split_join(left.where("false"), right, ["a"], "left")
    assert empty.count() == 0 and empty.columns == ["id", "a", "b", "v", "c"]
    assert skew.split_join(left, right.where("false"), ["a"], "left").count() == 50
    assert skew.split_join(left.withColumn("a", F.lit(None).cast("long")), right, ["a"], "left").count() == 50
    with pytest.raises(ValueError):
        skew.split_join(left, right, ["a"], "full")


def test_no_task_stands_out(spark):
    """Rows by task of the shuffled part and of the hot part, without the adaptive plan's own splitting."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.shuffle.partitions")}
    left = left_rows(spark, 60_000).repartition(8)
    left = cut_lineage(left, "even_left", as_table=True)
    try:
        for k, v in {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.shuffle.partitions": "16"}.items():
            spark.conf.set(k, v)
        right = right_rows(spark).select("a", "c")
        plain = left.join(right, "a", "left").groupBy(F.spark_partition_id()).count().collect()
        split = skew.split_join(left, right, ["a"], "left").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    sizes = [r[1] for r in plain]
    assert max(sizes) > 5 * statistics.median(sizes)
    sizes = [r[1] for r in split if r[1] > 50]
    assert max(sizes) <= 3 * statistics.median(sizes)


FLAT = "entity_id string, test_id long, events_ga_session_id string, event_action string, is_session_in_treatment_raw string"


def test_session_flags_with_a_third_of_the_rows_on_one_session(spark):
    i = F.col("id")
    flat = spark.range(9000).select(
        F.lit("E").alias("entity_id"), (i % 2).alias("test_id"),
        F.when(i % 3 == 0, F.lit("hot")).when(i % 3 == 1, F.lit(None)).otherwise(i.cast("string")).alias("events_ga_session_id"),
        F.when(i % 5 == 0, F.lit("shop_details.loaded")).otherwise(F.lit("home_screen.loaded")).alias("event_action"),
        F.when(i % 5 == 0, F.when(i % 2 == 0, F.lit("Y")).otherwise(F.lit("N"))).otherwise(F.lit("Unknown"))
        .alias("is_session_in_treatment_raw"))
    names = spark.createDataFrame([("E", 0, "zero")], "entity_id string, test_id long, test_name string")
    flags = se.session_treatment_flags(flat)
    got = se.attach_session_flag(flat, flags, names)
    want = (flat.join(flags.select(*se.SESSION_KEYS, "is_session_in_treatment_agg"), list(se.SESSION_KEYS), "left")
            .join(names, ["entity_id", "test_id"], "left").select(*got.columns))
    assert rows(got) == rows(want)
    assert got.where("events_ga_session_id is null and is_session_in_treatment_agg is not null").count() == 0


def test_vendor_lookup_beyond_the_bound(spark):
    left = left_rows(spark, 3000)
    right = cut_lineage(right_rows(spark), "vendors")
    small = skew.lookup_join(left, right, ["a", "b"])
    large = skew.lookup_join(left, right, ["a", "b"], max_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "Union" in large._jdf.queryExecution().analyzed().toString()
    assert rows(small.select(*large.columns)) == rows(large)
