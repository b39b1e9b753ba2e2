"""Proven-bound broadcast and lineage cuts."""
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import bounded_broadcast, known_rows


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_cut_lineage_records_rows(spark):
    df = cut_lineage(spark.range(7).where("id % 2 = 0"), "evens")
    assert known_rows(df) == 4 and df.count() == 4


def test_bounded_broadcast_uses_bound(spark):
    df = spark.range(100)
    assert bounded_broadcast(df, max_rows=10, bound=1000) is df          # too big: left to the planner
    hinted = bounded_broadcast(df, max_rows=1000, bound=100)
    assert hinted is not df and "broadcast" in _plan(hinted).lower()
    assert bounded_broadcast(df, max_rows=10) is df                      # nothing proven


def test_bounded_broadcast_survives_disabled_auto_broadcast(spark):
    # cluster sessions switch the estimate-based broadcast off; proven ones stay
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big, small = spark.range(1000), spark.range(10)
        plan = big.join(bounded_broadcast(small, max_rows=100, bound=10), "id")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bytes_decide_on_each_side_of_the_bound(spark):
    """Few rows with long values: the rows pass, the bytes do not."""
    from pyspark.sql import functions as F

    from armlens.plans.sizing import known_size
    rings = spark.range(40).select("id", F.array_repeat(F.struct(F.rand(1).alias("lon"), F.rand(2).alias("lat")), 500).alias("shape"),
                                   F.repeat(F.lit("é"), 100).alias("name"))
    df = cut_lineage(rings, "rings")
    size = known_size(df)
    assert size.rows == 40 and 40 * (500 * 32 + 200) <= size.bytes <= 40 * (500 * 32 + 200 + 200)
    assert bounded_broadcast(df, max_bytes=size.bytes) is not df
    assert bounded_broadcast(df, max_bytes=size.bytes - 1) is df
    # a derived key set is decided on its own size where its source proves too little
    keys = df.select("id").distinct()
    assert "broadcast" in _plan(bounded_broadcast(keys, bound=size, max_bytes=10_000, measure=True)).lower()
    assert "broadcast" not in _plan(bounded_broadcast(keys, bound=size, max_bytes=100, measure=True)).lower()
    assert bounded_broadcast(keys, bound=size, max_bytes=10_000) is keys


def test_value_bytes_of_every_kind(spark):
    from pyspark.sql import functions as F

    from armlens.plans.sizing import row_bytes
    df = spark.sql("""select 1 a, 'abc' s, cast(null as string) n, cast(1 as decimal(38,2)) d, array(1, 2) i, array('x', null) t,
                      named_struct('p', 1, 'q', 'yy') st, map('k', 1) m, cast(null as array<string>) na, date'2020-01-01' dt""")
    assert df.select(row_bytes(df)).first()[0] == 16 + 8 + 19 + 16 + 24 + 40 + 24 + 33 + 16 + 8 + 18 + (24 + 17) + (24 + 8) + 24 + 8
    assert F


def test_membership_beyond_the_bound_is_split(spark):
    from armlens.operators.orders import semi_filter
    from armlens.plans.sizing import Size
    facts = cut_lineage(spark.range(3000).selectExpr("if(id % 3 = 0, 1, id) as k"), "facts", as_table=True)
    keys = spark.range(0, 2000, 2).selectExpr("id + 1 as k")
    small = semi_filter(facts, keys, 5000, Size(1000, 50_000))
    large = semi_filter(facts, keys, 10, Size(1000, 50_000))
    assert "Union" in large._jdf.queryExecution().analyzed().toString()
    assert sorted(small.collect()) == sorted(large.collect()) and small.count() > 1000
