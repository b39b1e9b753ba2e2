"""JN-9 / FLT-20: the cell index gives what walking every edge gives."""
import math
import random

import pytest
from pyspark.sql import functions as F

from armlens.operators.zones import ZoneIndex, in_shape
from armlens.plans.sizing import with_rows

SCHEMA = "zone string, zone_shape array<array<struct<lon:double,lat:double>>>"


def star(rnd, cx, cy, r, n):
    turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + rnd.uniform(0.2, 1) * r * math.cos(a), cy + rnd.uniform(0.2, 1) * r * math.sin(a)) for a in turns]


def zones(rnd, n=12):
    out = []
    for k in range(n):
        cx, cy, r = rnd.uniform(-50, 50), rnd.uniform(-50, 50), 10 ** rnd.uniform(-3, 1.3)
        rings = [star(rnd, cx, cy, r, rnd.randrange(3, 40)) for _ in range(rnd.randrange(1, 4))]
        out.append((f"z{k % 8}", rings))  # two shapes share some keys
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    out += [("s", [square, [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)], [(1.5, 1.5), (2.5, 1.5), (2.0, 2.5)]]),
            ("s", [square]), ("flat", [[(1.0, 1.0), (2.0, 2.0)]]), ("none", None), ("empty", []),
            ("hole", [[(0.0, 0.0), (4.0, 0.0), (None, 2.0), (0.0, 4.0)]]), ("line", [[(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)]])]
    return out


def points(rnd, table, n=60):
    out = []
    for z, rings in table:
        flat = [p for r in rings or [] for p in r if None not in p] or [(1.0, 1.0), (3.0, 3.0)]
        xs, ys = [p[0] for p in flat], [p[1] for p in flat]
        for _ in range(n):
            out.append((z, rnd.uniform(min(xs) - 0.01, max(xs) + 0.01), rnd.uniform(min(ys) - 0.01, max(ys) + 0.01)))
        for (ax, ay), (bx, by) in zip(flat, flat[1:]):
            out += [(z, ax, ay), (z, (ax + bx) / 2, (ay + by) / 2), (z, ax, by)]
        out += [(z, x / 4, y / 4) for x in range(0, 17, 2) for y in range(0, 17, 3)]
    return out + [("s", None, 1.0), ("s", 1.0, None), (None, 1.0, 1.0), ("unknown", 1.0, 1.0)]


@pytest.mark.parametrize("seed,max_cells", [(1, 256), (2, 16), (3, 1), (4, 4096)])
def test_index_equals_walking_every_edge(spark, seed, max_cells):
    rnd = random.Random(seed)
    table = zones(rnd)
    zone_df = spark.createDataFrame(table, SCHEMA)
    pts = spark.createDataFrame([(k, *p) for k, p in enumerate(points(rnd, table))], "id int, zone string, lon double, lat double")
    walked = pts.join(zone_df, "zone").where(in_shape(F.col("zone_shape"), F.col("lon"), F.col("lat"))).withColumn(
        "shape_no", F.xxhash64("zone_shape"))
    want = sorted(map(tuple, walked.select("id", "shape_no").collect()))
    got = sorted(map(tuple, ZoneIndex(zone_df, ["zone"], max_cells=max_cells).locate(pts, "lon", "lat").select("id", "shape_no").collect()))
    assert got == want and len(got) > 200
    # without a key: the same as testing every point with every zone
    few = pts.where("id % 9 = 0").drop("zone")
    every = few.crossJoin(zone_df).where(in_shape(F.col("zone_shape"), F.col("lon"), F.col("lat")))
    want = sorted(map(tuple, every.select("id", "zone").collect()))
    found = ZoneIndex(zone_df, names=["zone"], max_cells=max_cells).locate(few, "lon", "lat")
    assert sorted(map(tuple, found.select("id", "zone").collect())) == want


def test_cells_are_bounded_and_mostly_without_edges(spark):
    circle = [(50 * math.cos(k / 500 * math.pi), 50 * math.sin(k / 500 * math.pi)) for k in range(1000)]
    zone = spark.createDataFrame([("a", [circle])], SCHEMA)
    cells = ZoneIndex(zone, ["zone"], max_cells=1024).cells.collect()
    assert len(cells) <= 1024 and sum(not c.edges for c in cells) > len(cells) / 2
    assert max(len(c.edges) for c in cells) < 100  # of 1000


def test_equal_zone_rows_multiply_points_once_each(spark):
    ring = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]]
    zone = spark.createDataFrame([("a", ring), ("a", ring)], SCHEMA)
    pts = spark.createDataFrame([("a", 3.0, 1.0)], "zone string, lon double, lat double")
    assert ZoneIndex(zone, ["zone"]).locate(pts, "lon", "lat").count() == 2


def test_single_ring_shapes_and_plan(spark):
    zone = with_rows(spark.createDataFrame([("a", [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)])],
                                           "zone string, zone_shape array<struct<lon:double,lat:double>>"), 1)
    pts = spark.range(100).select(F.concat(F.lit("a"), F.substring(F.col("id").cast("string"), 9, 1)).alias("zone"), (F.col("id") % 10 / 2).alias("lon"), (F.col("id") / 25).alias("lat"))
    found = ZoneIndex(zone, ["zone"]).locate(pts, "lon", "lat")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "cell_x" in plan.split("BroadcastHashJoin")[1]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    walked = pts.where(in_shape(F.array(F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in
                                                   ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0))])), F.col("lon"), F.col("lat")))
    assert found.count() == walked.count() > 5
    # past the bound the cells are joined by shuffle, still by equality
    beyond = ZoneIndex(with_rows(zone, 10 ** 7), ["zone"], max_rows=5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in beyond.locate(pts, "lon", "lat")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
