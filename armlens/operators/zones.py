"""Point-in-zone joins through a cell index (JN-9, FLT-20).

A shape is one ring of vertices or a list of rings. A point is inside when a ray
to the right crosses an odd number of edges of all rings together: holes, parts
and islands need no marking. Points on an edge or a vertex are outside.

``ZoneIndex`` cuts the bounding box of every shape into at most ``max_cells``
square cells. Their side is a power of two, so a coordinate times the scale is
exact and a point and the index always agree on its cell. A cell is

* dropped if it lies outside,
* kept without edges if it lies wholly inside,
* kept with the edges a point in it still has to test if an edge touches it.
  Edges left of the cell are never crossed; edges right of it that span its whole
  height are always crossed and enter as one parity bit.

``locate`` joins points to cells by equality on (zone key, shape, cell). The
cells of a measured zone table are measured as well and broadcast behind that
size; beyond it both sides shuffle on the cell, so a dense zone is spread over
its cells.

NULL shapes, rings of fewer than three vertices and rings with a NULL vertex hold
nothing; points with a NULL coordinate are in no zone. Coordinates must stay below 2**30
in magnitude (cells of up to 2**30 a side are tried).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armlens.functions.geo import crosses_edge, on_edge
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import bounded_broadcast, known_size

MAX_CELLS = 256
FINEST, COARSEST = 20, -30  # log2 of cells a unit
MARGIN = 2.0 ** -12         # of a cell: an edge this near to a cell counts as touching it


def ring_list(df: DataFrame, shape: str) -> Column:
    """The rings of a shape column that holds one ring or a list of rings."""
    one = isinstance(df.schema[shape].dataType.elementType, T.StructType)
    return F.array(F.col(shape)) if one else F.col(shape)


def ring_edges(rings: Column) -> Column:
    """array<struct<ax, ay, bx, by>> of all rings."""
    def of(ring):
        n = F.size(ring)
        after = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
        edges = F.zip_with(ring, after, lambda a, b: F.struct(
            a["lon"].cast("double").alias("ax"), a["lat"].cast("double").alias("ay"),
            b["lon"].cast("double").alias("bx"), b["lat"].cast("double").alias("by")))
        open_ = F.exists(ring, lambda v: v["lon"].isNull() | v["lat"].isNull())
        return F.when((n >= 3) & ~open_, edges)
    return F.flatten(F.filter(F.transform(rings, of), lambda e: e.isNotNull()))


def _scale(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _cell(x: Column, scale: Column) -> Column:
    return F.floor(x * scale).cast("long")


class ZoneIndex:
    """Cells of the distinct (``keys``, ``names``, ``shape``) of ``zones``. ``keys``: columns that a point has
    too and must agree on; ``names``: columns that tell what was found."""

    def __init__(self, zones: DataFrame, keys=(), names=(), shape: str = "zone_shape", max_cells: int = MAX_CELLS,
                 max_rows: int = 2_000_000):
        self.keys, self.max_rows = list(keys), max_rows
        self.own = [*self.keys, *names, "shape_no"]
        self.size = known_size(zones)
        low, high = F.array_min, F.array_max
        xs = F.concat(F.transform("_edges", lambda e: e["ax"]), F.transform("_edges", lambda e: e["bx"]))
        ys = F.concat(F.transform("_edges", lambda e: e["ay"]), F.transform("_edges", lambda e: e["by"]))
        boxed = (zones.select(*self.keys, *names, F.xxhash64(shape).alias("shape_no"), ring_edges(ring_list(zones, shape)).alias("_edges"))
                 .where(F.size("_edges") > 0)
                 .select("*", low(xs).alias("_x0"), high(xs).alias("_x1"), low(ys).alias("_y0"), high(ys).alias("_y1")))

        def cells(level):
            s = _scale(level)
            return (F.floor(F.col("_x1") * s) - F.floor(F.col("_x0") * s) + 1) * (
                F.floor(F.col("_y1") * s) - F.floor(F.col("_y0") * s) + 1)

        fits = F.filter(F.sequence(F.lit(COARSEST), F.lit(FINEST)), lambda level: cells(level) <= max_cells)
        self._zones = boxed.withColumn("level", F.coalesce(high(fits), F.lit(COARSEST)))

    @property
    def levels(self) -> DataFrame:
        """(keys, names, shape_no, level): one row per row of the zone table that has an area."""
        return self._zones.select(*self.own, "level")

    @property
    def cells(self) -> DataFrame:
        """(keys, names, shape_no, level, cell_x, cell_y, odd, edges): the cells that may hold points."""
        own = [*self.own, "level"]
        s = _scale(F.col("level"))
        span = lambda a, b, scale: F.sequence(_cell(F.col(a), scale), _cell(F.col(b), scale))
        bands = self._zones.dropDuplicates(self.own).select(
            *own, "_edges", "_x0", "_x1", (F.lit(MARGIN) / s).alias("_near"), (F.lit(1.0) / s).alias("_side"),
            F.explode(span("_y0", "_y1", s)).alias("cell_y"))
        low, high = F.col("cell_y") * F.col("_side"), (F.col("cell_y") + 1) * F.col("_side")
        inside_band = F.filter("_edges", lambda e: (F.greatest(e["ay"], e["by"]) >= low) & (F.least(e["ay"], e["by"]) <= high))

        def reach(e):
            """Edge with its x range inside the band, and whether it spans the band."""
            def at(y):
                y = F.least(F.greatest(y, F.least(e["ay"], e["by"])), F.greatest(e["ay"], e["by"]))
                return e["ax"] + (e["bx"] - e["ax"]) * F.try_divide(y - e["ay"], e["by"] - e["ay"])
            flat = e["ay"] == e["by"]
            a = F.when(flat, e["ax"]).otherwise(at(low))
            b = F.when(flat, e["bx"]).otherwise(at(high))
            return F.struct(e.alias("e"), (F.least(a, b) - F.col("_near")).alias("from"), (F.greatest(a, b) + F.col("_near")).alias("to"),
                            ((F.least(e["ay"], e["by"]) <= low) & (F.greatest(e["ay"], e["by"]) >= high)).alias("spans"))

        bands = bands.select(*own, "_x0", "_x1", "_side", "cell_y", F.transform(inside_band, reach).alias("_band"))
        grid = bands.select(*own, "cell_y", "_band", "_side",
                            F.explode(span("_x0", "_x1", s)).alias("cell_x"))
        left, right = F.col("cell_x") * F.col("_side"), (F.col("cell_x") + 1) * F.col("_side")
        middle = (F.col("cell_y") + 0.5) * F.col("_side")
        touched = F.exists("_band", lambda b: (b["from"] <= right) & (b["to"] >= left))
        beyond = F.filter("_band", lambda b: b["from"] > right)
        spanning = F.size(F.filter(beyond, lambda b: b["spans"])) % 2 == 1
        centre = F.size(F.filter(beyond, lambda b: (b["e"]["ay"] > middle) != (b["e"]["by"] > middle))) % 2 == 1
        rest = F.transform(F.filter("_band", lambda b: (b["to"] >= left) & ((b["from"] <= right) | ~b["spans"])), lambda b: b["e"])
        cells = grid.select(*own, "cell_x", "cell_y", F.when(touched, spanning).otherwise(centre).alias("odd"),
                            F.when(touched, rest).otherwise(F.slice(rest, 1, 0)).alias("edges"))
        return cells.where((F.size("edges") > 0) | F.col("odd"))

    def locate(self, points: DataFrame, lon, lat) -> DataFrame:
        """``points`` (which hold the key columns) with names and ``shape_no`` of every zone row of their key
        that contains them. Without keys every zone is a candidate: a point then looks up its cell at each
        level in use (at most ``FINEST - COARSEST + 1``, read once from the zone table)."""
        lon, lat = (F.col(c) if isinstance(c, str) else c for c in (lon, lat))
        known = points.where(lon.isNotNull() & lat.isNotNull())
        if self.keys:
            levels = bounded_broadcast(self.levels, self.max_rows, self.size)
            known = known.join(levels, self.keys, "inner")
            on = list(self.own)
        else:
            used = [r[0] for r in self._zones.select("level").distinct().collect()]
            known = known.withColumn("level", F.explode(F.array(*[F.lit(k) for k in used]).cast("array<int>")))
            on = ["level"]
        s = _scale(F.col("level"))
        known = known.withColumns({"cell_x": _cell(lon, s), "cell_y": _cell(lat, s)})
        cells = self.cells.drop(*([] if not self.keys else ["level"]))
        if self.size is not None:  # a zone table: its cells become one too, and decide by their own size
            cells = bounded_broadcast(cut_lineage(cells, "zone_cells"), self.max_rows)
        on += ["cell_x", "cell_y"]
        hit = known.join(cells, on, "inner").where(in_cell(F.col("odd"), F.col("edges"), lon, lat))
        return hit.drop("level", "cell_x", "cell_y", "odd", "edges")


def in_cell(odd: Column, edges: Column, x: Column, y: Column) -> Column:
    """Whether a point of a cell is inside; a cell without edges needs no walk."""
    parts = lambda e: (e["ax"], e["ay"], e["bx"], e["by"])
    crossed = F.size(F.filter(edges, lambda e: crosses_edge(x, y, *parts(e)))) % 2 == 1
    touches = F.exists(edges, lambda e: on_edge(x, y, *parts(e)))
    return F.when(F.size(edges) == 0, odd).otherwise((odd != crossed) & ~touches)


def in_shape(rings: Column, x: Column, y: Column) -> Column:
    """Containment by walking every edge: what the index must agree with."""
    edges = ring_edges(rings)
    return F.when(rings.isNull() | x.isNull() | y.isNull(), F.lit(None).cast("boolean")).otherwise(
        in_cell(F.lit(False), edges, x, y))
