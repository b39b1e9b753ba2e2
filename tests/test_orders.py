"""DOM-8 .. DOM-13 building blocks (JN-8a/8b, T7, T9, T11, T19, T21, DOM-9)."""
import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from armlens.operators import orders as od


def test_time_condition(spark):
    rows = [  # local order ts, start, end, active day
        (dt.datetime(2024, 1, 1, 10), None, None, None),  # no condition -> match
        (dt.datetime(2024, 1, 1, 10), dt.datetime(2023, 12, 1), dt.datetime(2024, 2, 1), "MONDAY"),
        (dt.datetime(2024, 1, 2, 10), dt.datetime(2023, 12, 1), dt.datetime(2024, 2, 1), "MONDAY"),
        (dt.datetime(2024, 1, 1, 10), dt.datetime(2023, 12, 1), dt.datetime(2024, 2, 1), None),  # T19
        (dt.datetime(2024, 3, 4, 10), dt.datetime(2023, 12, 1), dt.datetime(2024, 2, 1), "MONDAY"),
    ]
    df = spark.createDataFrame(rows, "t timestamp, s timestamp, e timestamp, d string")
    out = [r[0] for r in df.select(od.time_condition(F.col("t"), F.col("s"), F.col("e"), F.col("d"))).collect()]
    assert [bool(x) for x in out] == [True, True, False, False, False]


def test_customer_condition(spark):
    rows = [  # total orders, placed, first order, orders limit, days limit
        (2, dt.datetime(2024, 1, 10), None, 5, None),  # T19: first-order date NULL still matches
        (2, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 1), 5, 30),
        (2, dt.datetime(2024, 1, 10), dt.datetime(2023, 1, 1), 5, 30),
        (7, dt.datetime(2024, 1, 10), None, 5, None),
        (7, dt.datetime(2024, 1, 10), None, None, None),
        (1, dt.datetime(2024, 1, 10), None, None, 3),  # orders < NULL never matches
    ]
    df = spark.createDataFrame(rows, "n bigint, p timestamp, f timestamp, ol bigint, dl bigint")
    c = od.customer_condition(F.col("n"), F.col("p"), F.col("f"), F.col("ol"), F.col("dl"))
    assert [bool(r[0]) for r in df.select(c).collect()] == [True, True, False, False, True, False]


def flags(spark, rows, mode):
    """Flags of (group, variant, scheme) rows; every row is a test of its own with its own list."""
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "test_id long, tg string, variant string, s bigint, lst string")
    df = df.withColumns({"entity_id": F.lit("E"), "country_code": F.lit("C")})
    combos = df.withColumns({"tg_var_scheme_concat": F.col("lst"), "tg_var_scheme_list": F.split("lst", ", ")})
    groups = df.where("tg is not null").withColumn("tg_name", F.col("tg"))
    table = od.scheme_matches(combos, df, groups, mode)
    label = F.coalesce("tg", F.lit("Non_TG"))
    on = ["entity_id", "country_code", "test_id", "variant", "label"]
    joined = df.withColumn("label", label).join(table, on, "left")
    flag = od.scheme_flag(F.col("label") == "Non_TG", F.col("label"), F.col("variant"), F.col("s"), F.col("_after"), F.col("_wild"), mode)
    return [r[0] for r in joined.orderBy("test_id").select(flag).collect()]


def like(lst, combo):
    """SQL LIKE '%combo%' on the list."""
    if combo is None or lst is None:
        return False
    out = "".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in combo)
    return re.search(out, lst, re.S) is not None


def test_keep_drop_substring_vs_exact(spark):
    rows = [("TG1", "Control", 12, "TG1 | Control | 123"),  # T7: prefix of the scheme
            ("TG1", "Control", 123, "TG1 | Control | 123"),
            (None, "Control", 5, "TG1 | Control | 123"),      # outside every TG -> Keep
            ("TG1", "Control", None, "TG1 | Control | 123")]  # NULL scheme -> Drop
    assert flags(spark, rows, "substring") == ["Keep", "Keep", "Keep", "Drop"]
    assert flags(spark, rows, "exact") == ["Drop", "Keep", "Keep", "Drop"]


def test_scheme_matches_equal_a_string_search_in_every_order(spark):
    lists = ["TG1 | Control | 123, TG1 | V1 | 45, TG12 | Control | 7", "XTG1 | Control | 123", "TG1 | Control | 123 | 9",
             "a | a | a | a | 5", "T_1 | Control | 12", "TG1 | Con%ol | 12", "", None, r"TG1 | Q\E | 12", "TG1 | .* | 12, TG1 | (x | 3"]
    labels = ["TG1", "TG12", "1", "a", "T_1", "TG%", "G1"]
    variants = ["Control", "V1", "a", "Con%ol", "Cont_ol", ".*", "(x", r"Q\E"]
    rows = [(g, v, s, x) for g in labels for v in variants for s in (1, 12, 123, 4, 45, 5, 7, 1234, 9) for x in lists]
    got = flags(spark, rows, "substring")
    want = ["Keep" if like(x, f"{g} | {v} | {s}") else "Drop" for g, v, s, x in rows]
    assert got == want and want.count("Keep") > 30
    got = flags(spark, rows, "exact")
    assert got == ["Keep" if x is not None and f"{g} | {v} | {s}" in x.split(", ") else "Drop" for g, v, s, x in rows]


def test_multiplication_counts_rows_beyond_one_an_order(spark):
    df = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", "b"), ("u", "a"), ("u", None)], "test string, order_id string")
    assert sorted(map(tuple, od.multiplication(df, ["test"]).collect())) == [("t", 3, 2, 1, 2), ("u", 1, 1, 0, 1)]


def test_actual_fee_by_region(spark):
    rows = [("Europe", Decimal("3.0"), False, None, Decimal("5.0")),
            ("Europe", None, True, None, Decimal("5.0")),
            ("MENA", Decimal("3.0"), None, False, Decimal("5.0")),
            (None, Decimal("3.0"), False, False, Decimal("5.0"))]  # T21
    df = spark.createDataFrame(rows, "r string, o decimal(18,4), d boolean, v boolean, fee decimal(18,4)")
    incl = od.fee_incl_discounts(F.col("d"), F.col("v"), F.col("fee"))
    out = [r[0] for r in df.select(od.actual_fee(F.col("r"), F.col("o"), incl, ("Europe", "Asia"))).collect()]
    assert [None if x is None else float(x) for x in out] == [3.0, 0.0, 5.0, None]


def test_revenue_nulls_and_zero_divisor(spark):
    rows = [(True, Decimal("10"), Decimal("1"), Decimal("0"), Decimal("2"), Decimal("1"), Decimal("0.25"),
             Decimal("4")),
            (None, Decimal("10"), Decimal("1"), Decimal("0"), Decimal("2"), Decimal("1"), Decimal("0.25"),
             Decimal("4")),
            (True, Decimal("10"), None, Decimal("0"), Decimal("2"), Decimal("1"), Decimal("0.25"), Decimal("4")),
            (True, Decimal("10"), Decimal("1"), Decimal("0"), Decimal("2"), Decimal("1"), Decimal("-1"),
             Decimal("4"))]
    df = spark.createDataFrame(rows, "is_own_delivery boolean, actual_df_paid_by_customer decimal(18,4), "
                                     "commission_local decimal(18,4), joker_vendor_fee_local decimal(18,4), "
                                     "service_fee_local decimal(18,4), sof_local decimal(18,4), "
                                     "vat_ratio decimal(9,4), delivery_costs_local decimal(18,4)")
    out = od.revenue_columns(df).select("revenue_local", "gross_profit_local").collect()
    vals = [(None if a is None else float(a), None if b is None else float(b)) for a, b in out]
    assert vals[0] == pytest.approx((11.4, 7.4))
    assert vals[1] == pytest.approx((3.4, -0.6))  # own delivery NULL -> fee part 0
    assert vals[2] == (None, None)                       # T9: commission NULL -> revenue NULL
    assert vals[3] == (None, None)                       # 1 + vat = 0 -> SAFE_DIVIDE NULL


def test_allowed_vertical_keys(spark):
    tg = spark.createDataFrame([("E", "C", 1, "shop", "darkstores"), ("E", "C", 2, None, None)],
                               "entity_id string, country_code string, test_id bigint, "
                               "first_parent_vertical string, second_parent_vertical string")
    keys = sorted(tuple(r) for r in od.allowed_vertical_keys(tg).collect())
    assert keys == [("E", "C", 1, "darkstores"), ("E", "C", 1, "shop")]  # T11: test 2 keeps nothing


def test_day_number_in_test(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 23)),
                                (dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 1))],
                               "s timestamp, o timestamp")
    d = F.datediff(F.to_date("o"), F.date_add(F.to_date("s"), 1)) + 1
    assert [r[0] for r in df.select(d).collect()] == [0, 1]
