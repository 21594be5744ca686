"""Planar and great-circle geometry as native Spark column expressions.

Model
-----
* A point is two double columns (``x`` = longitude, ``y`` = latitude), or
  ``struct<x,y>`` from :func:`point`.
* A polygon set is GeoJSON MultiPolygon coordinates,
  ``array<array<array<array<double>>>>`` (polygons -> rings -> vertices -> [x, y]);
  a plain Polygon is wrapped in one more array by the GeoJSON reader.
* A *prepared* polygon is ``edges array<struct<x1,y1,x2,y2>>`` plus its bounding
  box.  Point-in-polygon is an even-odd ray cast over all edges, so holes and
  multi-part polygons need no extra code, and a dissolved edge set (see
  :mod:`tessera.operators.dissolve`) is queried the same way.

Boundary rule: the ray cast is half-open, so a point exactly on an edge may count
as inside or outside.  :func:`on_boundary` tests that case, without a tolerance exactly
on coordinates of ``GRID_DIGITS`` decimals, and :func:`within` can count it either way.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

EDGE_TYPE = StructType([StructField(n, DoubleType()) for n in ("x1", "y1", "x2", "y2")])
EDGES_TYPE = ArrayType(EDGE_TYPE)
MULTIPOLYGON_TYPE = ArrayType(ArrayType(ArrayType(ArrayType(DoubleType()))))

# Without a tolerance, places are compared as numbers of so many decimals.
GRID_DIGITS = 9

# How a point on a polygon's boundary counts: as the ray cast has it, not within (the OGC rule), or within.
BOUNDARY_RULES = ("half_open", "outside", "inside")

# Mean Earth radius in metres, the default sphere for great-circle distances.
EARTH_RADIUS_M = 6371008.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(x: Column | str, y: Column | str) -> Column:
    """``ST_Point(x, y)`` as ``struct<x double, y double>``."""
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def polygon_edges(multipolygon: Column | str) -> Column:
    """MultiPolygon coordinates -> ``array<struct<x1,y1,x2,y2>>`` over every ring.

    Rings that are not closed get their closing edge; rings with fewer than two
    vertices contribute nothing.
    """
    rings = F.flatten(_c(multipolygon))

    def ring_edges(ring: Column) -> Column:
        closed = F.when(ring[0] == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.array(ring[0])))
        n = F.size(closed)
        return F.when(
            n < 2, F.array().cast(EDGES_TYPE)
        ).otherwise(
            F.transform(
                F.sequence(F.lit(0), n - 2),
                lambda i: F.struct(
                    closed[i][0].alias("x1"), closed[i][1].alias("y1"),
                    closed[i + 1][0].alias("x2"), closed[i + 1][1].alias("y2"),
                ),
            )
        )

    return F.coalesce(F.flatten(F.transform(rings, ring_edges)), F.array().cast(EDGES_TYPE))


def edges_bbox(edges: Column | str) -> dict[str, Column]:
    """Bounding box columns ``x_min, x_max, y_min, y_max`` of an edge list."""
    e = _c(edges)
    return {
        "x_min": F.array_min(F.transform(e, lambda s: F.least(s.x1, s.x2))),
        "x_max": F.array_max(F.transform(e, lambda s: F.greatest(s.x1, s.x2))),
        "y_min": F.array_min(F.transform(e, lambda s: F.least(s.y1, s.y2))),
        "y_max": F.array_max(F.transform(e, lambda s: F.greatest(s.y1, s.y2))),
    }


def _crossing(px: Column, py: Column, e: Column) -> Column:
    # The edge straddles the horizontal line through the point (half-open in y), and the
    # crossing lies to the right of the point.  The inner CASE only runs for straddling
    # edges, so y2 - y1 is never zero there (ANSI mode raises on division by zero).
    straddles = (e.y1 > py) != (e.y2 > py)
    x_at = (e.x2 - e.x1) * (py - e.y1) / (e.y2 - e.y1) + e.x1
    return F.when(straddles, F.when(px < x_at, F.lit(1)).otherwise(F.lit(0))).otherwise(F.lit(0))


def crossings(edges: Column | str, x: Column | str, y: Column | str) -> Column:
    """Number of edges a ray from ``(x, y)`` towards +x crosses."""
    px, py = _c(x), _c(y)
    return F.aggregate(_c(edges), F.lit(0), lambda acc, e: acc + _crossing(px, py, e))


def within(x: Column | str, y: Column | str, edges: Column | str, boundary: str = "half_open") -> Column:
    """``ST_Within(point, polygon)`` by the even-odd rule over a prepared edge list.

    ``boundary`` says how a point on an edge or a vertex counts (:data:`BOUNDARY_RULES`).
    """
    if boundary not in BOUNDARY_RULES:
        raise ValueError(f"unknown boundary rule {boundary!r}; expected one of {BOUNDARY_RULES}")
    odd = crossings(edges, x, y) % 2 == 1
    return odd if boundary == "half_open" else F.when(on_boundary(x, y, edges), F.lit(boundary == "inside")).otherwise(odd)


def _turn_is_zero(px: Column, py: Column, e: Column) -> Column:
    """Whether a point lies on the line of an edge, exactly on coordinates of ``GRID_DIGITS`` decimals.

    Where the cross product in doubles is clearly off zero, that settles it; else it is taken in whole numbers.
    """
    def grid(c: Column) -> Column:
        return F.round(c * 10.0 ** GRID_DIGITS).cast("decimal(18,0)")

    dx, dy, ux, uy = e.x2 - e.x1, e.y2 - e.y1, px - e.x1, py - e.y1
    rough = dx * uy - dy * ux
    reach = (F.abs(dx) + F.abs(dy) + F.abs(ux) + F.abs(uy)) * 10.0 ** -GRID_DIGITS * 4 + 10.0 ** (-2 * GRID_DIGITS)
    gx, gy = grid(e.x1), grid(e.y1)
    exact = ((grid(e.x2) - gx).cast("decimal(18,0)") * (grid(py) - gy).cast("decimal(18,0)")
             == (grid(e.y2) - gy).cast("decimal(18,0)") * (grid(px) - gx).cast("decimal(18,0)"))
    return F.when(F.abs(rough) > reach, F.lit(False)).otherwise(exact)


def on_boundary(x: Column | str, y: Column | str, edges: Column | str, tol: float = 0.0) -> Column:
    """True when the point lies on some edge: within ``tol`` of the segment, or exactly (see :data:`GRID_DIGITS`) without one."""
    px, py = _c(x), _c(y)
    slack = tol or 0.5 * 10.0 ** -GRID_DIGITS

    def on_edge(e: Column) -> Column:
        inside_box = (
            (px >= F.least(e.x1, e.x2) - slack) & (px <= F.greatest(e.x1, e.x2) + slack)
            & (py >= F.least(e.y1, e.y2) - slack) & (py <= F.greatest(e.y1, e.y2) + slack)
        )
        if not tol:
            return F.when(inside_box, _turn_is_zero(px, py, e)).otherwise(False)
        cross = (e.x2 - e.x1) * (py - e.y1) - (e.y2 - e.y1) * (px - e.x1)
        length = F.sqrt((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1))
        return inside_box & (F.abs(cross) <= F.lit(tol) * F.greatest(length, F.lit(1e-300)))

    return F.exists(_c(edges), on_edge)


def planar_distance(x1: Column | str, y1: Column | str, x2: Column | str, y2: Column | str) -> Column:
    """``ST_Distance`` between two points, in the unit of the coordinates."""
    dx = _c(x2) - _c(x1)
    dy = _c(y2) - _c(y1)
    return F.sqrt(dx * dx + dy * dy)


def sphere_distance(lon1: Column | str, lat1: Column | str, lon2: Column | str, lat2: Column | str,
                    radius: float = EARTH_RADIUS_M) -> Column:
    """``ST_DistanceSphere`` (haversine) in the unit of ``radius`` (metres by default)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    h = F.sin(dphi / 2) * F.sin(dphi / 2) + F.cos(p1) * F.cos(p2) * F.sin(dlmb / 2) * F.sin(dlmb / 2)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def ring_area(multipolygon: Column | str) -> Column:
    """Signed-area sum (shoelace) over all rings; absolute value per ring."""
    edges = polygon_edges(multipolygon)
    return F.abs(F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + (e.x1 * e.y2 - e.x2 * e.y1))) / 2


def signed_area(multipolygon: Column | str) -> Column:
    """Area of MultiPolygon coordinates whose holes run against their outer rings (the shoelace sum over all rings, as it is)."""
    return F.aggregate(polygon_edges(multipolygon), F.lit(0.0), lambda acc, e: acc + (e.x1 * e.y2 - e.x2 * e.y1)) / 2
