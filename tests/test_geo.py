"""JN-9 / FLT-20 / SC-17: containment with boundary exclusion, WKT."""
from pyspark.sql import functions as F

from armlens.functions.geo import point, point_in_ring, point_wkt

SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]


def ring_col(points):
    return F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in points])


def contains(spark, ring, pts):
    df = spark.createDataFrame(pts, "x double, y double")
    return [r[0] for r in df.select(point_in_ring(ring_col(ring), point("x", "y"))).collect()]


def test_unit_square(spark):
    pts = [(0.5, 0.5), (2.0, 0.5), (0.0, 0.5), (0.5, 0.0), (1.0, 1.0), (1.0, 0.5), (0.5, 1.0)]
    assert contains(spark, SQUARE, pts) == [True, False, False, False, False, False, False]


def test_closed_ring_and_concave(spark):
    closed = SQUARE + [SQUARE[0]]
    assert contains(spark, closed, [(0.5, 0.5), (1.5, 0.5)]) == [True, False]
    concave = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    assert contains(spark, concave, [(2.0, 3.0), (1.0, 1.0), (3.0, 2.0)]) == [False, True, True]


def test_null_point_is_null(spark):
    df = spark.createDataFrame([(None, 0.5)], "x double, y double")
    assert df.select(point_in_ring(ring_col(SQUARE), point("x", "y"))).first()[0] is None


def test_degenerate_ring(spark):
    assert contains(spark, [(0.0, 0.0), (1.0, 1.0)], [(0.5, 0.5)]) == [False]


def test_wkt(spark):
    df = spark.createDataFrame([(13.4, 52.5), (2.0, -0.0001), (None, 1.0)], "x double, y double")
    out = [r[0] for r in df.select(point_wkt(point("x", "y"))).collect()]
    assert out == ["POINT(13.4 52.5)", "POINT(2 -0.0001)", None]


def test_wkt_reads_back_as_the_same_doubles(spark):
    import random
    rnd = random.Random(3)
    points = [(rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for _ in range(300)]
    points += [(-0.0000001, 1e-12), (0.1 + 0.2, 89.99999999999999), (-0.0, 0.0)]
    df = spark.createDataFrame(points, "x double, y double")
    for r in df.select("x", "y", point_wkt(point("x", "y")).alias("t")).collect():
        lon, lat = r.t[len("POINT("):-1].split(" ")
        assert (float(lon), float(lat)) == (r.x, r.y)


def test_random_triangles_match_strict_interior(spark):
    """Property: for triangles, ray casting with boundary exclusion equals the
    strict-interior sign test (integer coordinates keep both exact)."""
    import random
    rnd = random.Random(7)

    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    rows, expected = [], []
    while len(rows) < 300:
        tri = [(float(rnd.randint(-5, 5)), float(rnd.randint(-5, 5))) for _ in range(3)]
        if cross(*tri) == 0:
            continue  # degenerate
        p = (float(rnd.randint(-6, 6)), float(rnd.randint(-6, 6)))
        c = [cross(tri[i], tri[(i + 1) % 3], p) for i in range(3)]
        expected.append(all(x > 0 for x in c) or all(x < 0 for x in c))
        rows.append(([{"lon": x, "lat": y} for x, y in tri], p[0], p[1]))
    df = spark.createDataFrame(rows, "ring array<struct<lon:double,lat:double>>, x double, y double")
    got = [r[0] for r in df.select(point_in_ring("ring", point("x", "y"))).collect()]
    assert got == expected and any(expected) and not all(expected)
