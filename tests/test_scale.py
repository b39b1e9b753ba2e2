"""Shuffles and columns of the order chain: what decides its time on large tables."""
import re

import pytest
from pyspark.sql import functions as F

from armlens.plans import queries as Q
from armlens.plans.sizing import row_bytes
from armlens.sources import adapters as A


@pytest.fixture
def shuffled_joins(spark):
    """Every join shuffles, as on tables too large to broadcast; the plan is final as planned."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


class World:
    """Two orders of one customer each, an order without a customer, a line that comes twice."""

    def __init__(self, spark):
        self.region = spark.createDataFrame([(0, "EUROPE")], "r_regionkey long, r_name string")
        self.nation = spark.createDataFrame([(1, "N1", 0), (2, "N2", 0)], "n_nationkey long, n_name string, n_regionkey long")
        self.customer = spark.createDataFrame([(10, 1), (11, 2), (None, 1)], "c_custkey long, c_nationkey long")
        self.orders = spark.createDataFrame(
            [(3, 10, "O", 1000.0), (4, 11, "O", 500.0), (5, None, "O", 1.0), (None, 10, "O", 1.0)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").withColumn(
                "o_orderdate", F.lit("1996-01-01").cast("date"))
        line = "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate string"
        self.lineitem = spark.createDataFrame(
            [(3, 1, 1, "1996-01-02"), (3, 2, 2, "1996-01-02"), (3, 3, 2, "1996-01-03"), (4, 1, 1, "1996-01-02"),
             (5, 1, 1, "1996-01-02"), (None, 1, 1, "1996-01-02"), (4, 2, 2, None)], line).select(
                "*", F.lit(100.0).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
                F.lit(7.0).alias("l_quantity"), F.lit("N").alias("l_returnflag")).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def _line_shuffles(df):
    """Exchanges on a customer key or on the distinct rows, whose rows would be lines."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^\n]*?), \d+\)", plan)
    return [k for k in keys if "l_shipdate" in k or "created_date_utc" in k or "code" in k], plan


def test_fee_overrides_shuffle_lines_once(spark, shuffled_joins):
    df = A.fee_override_orders(World(spark))
    again, _ = _line_shuffles(df)
    assert not again
    rows = sorted(((r.global_entity_id, r.code, str(r.created_date_utc), r.delivery_fee_local and str(r.delivery_fee_local))
                   for r in df.collect()))
    assert rows == [("E1", "P3", "1996-01-02", "1.0000"), ("E1", "P3", "1996-01-03", "1.0000"),
                    ("E2", "P4", "1996-01-02", None), ("E2", "P4", "None", None)]


def test_lines_meet_orders_that_know_their_customer(spark, shuffled_joins):
    """The only exchange on the customer key is of orders and customers, not of lines."""
    df = A.session_orders(World(spark))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    depth = {("l_orderkey" in j): len(j) - len(j.lstrip(" :+-")) for j in joins if "l_orderkey" in j or "c_custkey" in j}
    assert depth[True] < depth[False]
    assert sorted((r.order_id, r.entity_id) for r in df.collect()) == [("3", "E1")] * 3 + [("4", "E2")] * 2


def test_inference_table_holds_what_the_chain_reads(spark):
    df = Q._orders_cleaned_table(spark, "/root/testdata/sf0.001")
    assert "zone_shape" not in df.columns and len(df.columns) == 17
    whole = Q.dag(spark, "/root/testdata/sf0.001").orders_cleaned
    assert df.exceptAll(whole.select(*df.columns)).isEmpty() and whole.select(*df.columns).exceptAll(df).isEmpty()


def test_bytes_of_rings_need_no_walk(spark):
    df = spark.sql("""select array(named_struct('lon', 1.5D, 'lat', 2D), null) ring, array(cast(1 as decimal(38,2))) wide,
                      array(named_struct('a', 'xy', 'n', 1)) named, cast(null as array<struct<x:double,y:double>>) gone""")
    size = df.select(row_bytes(df).alias("b"))
    assert size.first()[0] == 16 + (24 + 2 * 32) + (24 + 24) + (24 + 16 + 18 + 8) + 24
    rings = df.select("ring")
    assert "aggregate(" not in rings.select(row_bytes(rings))._jdf.queryExecution().analyzed().toString()
