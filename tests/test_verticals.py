"""DOM-4 / DOM-15 truth tables (T4, T5, T21)."""
import pytest
from pyspark.sql import functions as F

from armlens.functions.verticals import first_parent_vertical, normalize_vertical, region_vertical, \
    second_parent_vertical


def split(spark, labels):
    df = spark.createDataFrame([(labels,)], "v array<string>")
    s = F.array_join(F.array_sort(F.array_distinct(F.filter("v", lambda x: x.isNotNull()))), ", ")
    r = df.select(s.alias("c")).select("c", first_parent_vertical("c").alias("f"),
                                       second_parent_vertical("c").alias("s")).first()
    return r.c, r.f, r.s


@pytest.mark.parametrize("labels,expected", [
    (["Restaurants"], ("Restaurants", "restaurant", None)),
    (["Shop", "darkstores"], ("Shop, darkstores", "shop", "darkstores")),
    (["Shop", "darkstores", "restaurant"], ("Shop, darkstores, restaurant", None, None)),  # greedy regex
    ([], ("", None, None)),
    ([None], ("", None, None)),
    (["courier"], ("courier", None, None)),
])
def test_first_second(spark, labels, expected):
    assert split(spark, labels) == expected


def test_binary_label_order(spark):
    # T5: 'Restaurant' < 'Shop' < 'darkstores' < 'restaurant'
    c, _, _ = split(spark, ["restaurant", "darkstores", "Shop", "Restaurant"])
    assert c == "Restaurant, Shop, darkstores, restaurant"


def test_normalize_order_vertical(spark):
    df = spark.createDataFrame([("Restaurants",), ("SHOP",), ("darkstores",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(normalize_vertical("v")).collect()] == [
        "restaurant", "shop", "darkstores", None, None]


@pytest.mark.parametrize("region,raw,expected", [
    ("Asia", "Food", "restaurant"), ("Americas", "dmarts", "shop"), ("MENA", "dmarts", "darkstores"),
    ("MENA", "Local Store", "shop"), ("Europe", "Food", "food"), ("Asia", "Other", "other"),
    (None, "Food", None), ("Africa", "Food", None),
])
def test_region_vertical(spark, region, raw, expected):
    df = spark.createDataFrame([(region, raw)], "r string, v string")
    assert df.select(region_vertical("r", "v")).first()[0] == expected
