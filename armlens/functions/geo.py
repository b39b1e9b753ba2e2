"""Planar point / polygon expressions (SC-16, SC-17, FLT-20).

Spark 4.1 has no usable geography type, so a zone shape is a ring
``array<struct<lon:double, lat:double>>`` (vertices in order; closing the ring
by repeating the first vertex is allowed) and a point is ``struct<lon, lat>``.

Containment is evaluated with higher-order functions over the ring's edges, so
it runs as a native Catalyst expression on every executor. Points on an edge or
a vertex are *not* contained (the warehouse semantics of ST_CONTAINS). Edges are
planar segments; the warehouse uses geodesic edges, which differ only for
shapes spanning hundreds of kilometres.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def point(lon, lat) -> Column:
    """SC-16: ST_GEOGPOINT(lon, lat)."""
    return F.struct(_c(lon).cast("double").alias("lon"), _c(lat).cast("double").alias("lat"))


def _coord_text(c: Column) -> Column:
    # the double's own text (it reads back as the same double) without an empty fraction: 13.4, 2;
    # small numbers are written out, tiny ones keep their exponent
    text = c.cast("string")
    written = F.regexp_replace(text.try_cast("decimal(38,30)").cast("string"), r"0+$", "")
    return F.when(text.contains("E-") & (F.abs(c) >= 1e-12), written).otherwise(F.regexp_replace(text, r"\.0$", ""))


def point_wkt(p) -> Column:
    """SC-17: ST_ASTEXT of a point struct, e.g. ``POINT(13.4 52.5)``."""
    p = _c(p)
    return F.when(
        p.isNotNull() & p["lon"].isNotNull() & p["lat"].isNotNull(),
        F.concat(F.lit("POINT("), _coord_text(p["lon"]), F.lit(" "), _coord_text(p["lat"]), F.lit(")")),
    )


def crosses_edge(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """A ray from (x, y) to the right crosses the edge; a NULL vertex is never crossed."""
    at = (bx - ax) * F.try_divide(y - ay, by - ay) + ax
    return F.coalesce(((ay > y) != (by > y)) & (x < at), F.lit(False))


def on_edge(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """(x, y) lies on the edge."""
    return F.coalesce(((x - ax) * (by - ay) - (y - ay) * (bx - ax) == 0)
                      & x.between(F.least(ax, bx), F.greatest(ax, bx))
                      & y.between(F.least(ay, by), F.greatest(ay, by)), F.lit(False))


def _edge_flags(x: Column, y: Column):
    def flags(a, b):
        ends = (a["lon"], a["lat"], b["lon"], b["lat"])
        return F.struct(crosses_edge(x, y, *ends).alias("crosses"), on_edge(x, y, *ends).alias("on_edge"))
    return flags


def point_in_ring(ring, p) -> Column:
    """FLT-20 / JN-9: even-odd ray casting with boundary exclusion.

    NULL ring or point gives NULL (so the predicate rejects the row in a
    WHERE clause, like the warehouse function); fewer than 3 vertices contain
    nothing."""
    ring, p = _c(ring), _c(p)
    x, y = p["lon"], p["lat"]
    n = F.size(ring)
    nxt = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    edges = F.zip_with(ring, nxt, _edge_flags(x, y))
    start = F.struct(F.lit(False).alias("odd"), F.lit(False).alias("edge"))
    inside = F.aggregate(edges, start, lambda s, e: F.struct(
        (s["odd"] != e["crosses"]).alias("odd"), (s["edge"] | e["on_edge"]).alias("edge")),
        lambda s: s["odd"] & ~s["edge"])
    return (
        F.when(ring.isNull() | p.isNull() | x.isNull() | y.isNull(), F.lit(None).cast("boolean"))
        .when(n < 3, F.lit(False))
        .otherwise(inside)
    )
