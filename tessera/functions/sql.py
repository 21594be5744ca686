"""The geometry functions for use inside SQL text, as SQL functions that the analyzer inlines (no UDF at run time).

``register_geometry_functions`` makes them for a session.  Points are ``struct<x, y>``, geometries MultiPolygon coordinates, and
prepared polygons edge lists, as in :mod:`.geometry`, whose rules they follow.  There is no spatial planner behind
SQL text: ``st_cell`` and ``st_cells`` give both sides of a join the keys that make it an equi-join, and a geometry union is
``st_union(collect_list(st_edges(geometry)))`` over members that tile their group.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .geometry import EARTH_RADIUS_M

_POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"
_EDGE = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>"
_EDGES = f"ARRAY<{_EDGE}>"
_GEOMETRY = "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"
_CELL = "STRUCT<gx: BIGINT, gy: BIGINT>"

# name and arguments, result, body
FUNCTIONS = (
    ("st_point(x DOUBLE, y DOUBLE)", _POINT, "named_struct('x', x, 'y', y)"),
    ("st_x(p " + _POINT + ")", "DOUBLE", "p.x"),
    ("st_y(p " + _POINT + ")", "DOUBLE", "p.y"),
    (f"st_distance(p {_POINT}, q {_POINT})", "DOUBLE", "sqrt((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y))"),
    (f"st_distance_sphere(p {_POINT}, q {_POINT})", "DOUBLE",
     f"2 * {EARTH_RADIUS_M!r}D * asin(sqrt(least(1D, pow(sin(radians(q.y - p.y) / 2), 2) "
     "+ cos(radians(p.y)) * cos(radians(q.y)) * pow(sin(radians(q.x - p.x) / 2), 2))))"),
    (f"st_edges(g {_GEOMETRY})", _EDGES,
     "coalesce(flatten(transform(transform(filter(flatten(g), r -> size(r) > 1), "
     "r -> CASE WHEN r[0] = element_at(r, -1) THEN r ELSE concat(r, array(r[0])) END), "
     "c -> transform(slice(c, 1, size(c) - 1), (a, i) -> named_struct('x1', a[0], 'y1', a[1], 'x2', c[i + 1][0], 'y2', c[i + 1][1])))), array())"),
    (f"st_within(p {_POINT}, edges {_EDGES})", "BOOLEAN",
     "aggregate(edges, 0, (n, e) -> n + CASE WHEN (e.y1 > p.y) != (e.y2 > p.y) THEN CASE WHEN "
     "p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END ELSE 0 END) % 2 = 1"),
    (f"st_cell(p {_POINT}, side DOUBLE)", _CELL, "named_struct('gx', floor(p.x / side), 'gy', floor(p.y / side))"),
    (f"st_cells(edges {_EDGES}, side DOUBLE)", f"ARRAY<{_CELL}>",
     "CASE WHEN size(edges) > 0 THEN flatten(transform("
     "sequence(floor(array_min(transform(edges, e -> least(e.x1, e.x2))) / side), floor(array_max(transform(edges, e -> greatest(e.x1, e.x2))) / side)), "
     "i -> transform(sequence(floor(array_min(transform(edges, e -> least(e.y1, e.y2))) / side), "
     "floor(array_max(transform(edges, e -> greatest(e.y1, e.y2))) / side)), j -> named_struct('gx', i, 'gy', j)))) ELSE array() END"),
    (f"st_undirected(members ARRAY<{_EDGES}>)", f"ARRAY<ARRAY<{_POINT}>>",
     "array_sort(flatten(transform(array_distinct(transform(members, m -> array_sort(transform(filter(m, e -> e.x1 != e.x2 OR e.y1 != e.y2), "
     "e -> array_sort(array(named_struct('x', round(e.x1, 9), 'y', round(e.y1, 9)), named_struct('x', round(e.x2, 9), 'y', round(e.y2, 9)))))))), m -> m)))"),
    # an edge on the union's boundary belongs to an odd number of members: in sorted order, the first of each odd run
    (f"st_union(members ARRAY<{_EDGES}>)", _EDGES,
     f"transform(aggregate(st_undirected(members), CAST(named_struct('kept', array(), 'odd', false) AS STRUCT<kept: ARRAY<ARRAY<{_POINT}>>, odd: BOOLEAN>), "
     "(a, e) -> CASE WHEN a.odd AND element_at(a.kept, -1) = e THEN named_struct('kept', slice(a.kept, 1, size(a.kept) - 1), 'odd', false) "
     "ELSE named_struct('kept', concat(a.kept, array(e)), 'odd', true) END).kept, "
     "e -> named_struct('x1', e[0].x, 'y1', e[0].y, 'x2', e[1].x, 'y2', e[1].y))"),
)


def register_geometry_functions(spark: SparkSession) -> list[str]:
    """Make the functions in the session; returns their names."""
    for signature, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {result} RETURN {body}")
    return [signature.partition("(")[0] for signature, _, _ in FUNCTIONS]
