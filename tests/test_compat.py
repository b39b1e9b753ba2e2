"""Column functions with SQL-dialect traps (SC-4, SC-5, SC-8, SC-11, SC-13, SC-14)."""
import datetime as dt

from pyspark.sql import functions as F

from armlens.functions import compat as C
from armlens.functions.strings import distinct_sorted_string_agg, sorted_string_agg


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_capture_or_null(spark):
    out = one(spark, C.capture_or_null("s", r"(.*),\s"), [("a, b, c",), ("single",), (None,)], "s string")
    assert out == ["a, b", None, None]  # greedy; no match -> NULL (not '')


def test_match_or_null(spark):
    out = one(spark, C.match_or_null("s", r"\d+"), [("Target Group 12",), ("none",)], "s string")
    assert out == ["12", None]


def test_if_else_null_condition_takes_else(spark):
    out = one(spark, C.if_else(F.col("b"), F.lit(1), F.lit(2)), [(True,), (False,), (None,)], "b boolean")
    assert out == [1, 2, 2]


def test_calendar_day_diff_counts_midnights(spark):
    # T18: 23:50 -> 00:10 next day is one day, not zero
    rows = [(dt.datetime(2024, 1, 2, 0, 10), dt.datetime(2024, 1, 1, 23, 50))]
    out = one(spark, C.calendar_day_diff("a", "b"), rows, "a timestamp, b timestamp")
    assert out == [1]


def test_weekday_name(spark):
    assert one(spark, C.weekday_name("d"), [(dt.date(2024, 1, 1),)], "d date") == ["Monday"]


def test_safe_divide(spark):
    out = one(spark, C.safe_divide("a", "b"), [(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert out == [None, 0.25]


def test_try_double(spark):
    assert one(spark, C.try_double("s"), [("1.5",), ("x",)], "s string") == [1.5, None]


def test_string_aggregates(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (1, "a"), (2, None)], "k int, v string")
    out = {r.k: (r.s, r.d) for r in df.groupBy("k").agg(sorted_string_agg("v").alias("s"),
                                                          distinct_sorted_string_agg("v").alias("d")).collect()}
    assert out[1] == ("a, a, b", "a, b")
    assert out[2] == ("", "")  # all NULL -> '' (not NULL)


def test_concat_propagates_null(spark):
    assert one(spark, F.concat(F.lit("TG"), F.col("x")), [(None,)], "x string") == [None]
