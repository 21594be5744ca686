"""Polygon union per group (``ST_Union_Aggr``) as edge parity.

For a tiling (polygons that do not overlap and share whole edges), an edge on the
union's boundary belongs to exactly one member, and an interior edge to two.  So:
explode every member's edges, snap their end points to a grid so that shared edges
compare equal, make them undirected, count per (group, edge), keep odd counts.  A
polygon that a group holds more than once (whatever its direction or first point) is
taken once, so that copies don't cancel each other.  The
result is the union's boundary as an edge list, which the even-odd ray cast queries
directly.  Everything is a shuffle aggregate: linear and distributed; the only
per-group collection is the union's *boundary*, whose size is set by the geometry,
not by the number of rows.

Members that overlap would cancel where they do.  ``overlapping=True`` takes the union of any polygons instead
(:mod:`.union`): edges cut where they meet, pieces kept that have one covered side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import edges_bbox, polygon_edges
from .union import union_aggregate


def _cols(cols) -> list:
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


def dissolve(df: DataFrame, by, geometry: str = "geometry", edges: str = "edges", aggs=(),
             snap_digits: int = 9, with_bbox: bool = True, overlapping: bool = False, cell_size: float | None = None) -> DataFrame:
    """Group rows by ``by``; union their polygons into ``edges`` and compute ``aggs``.

    ``df`` may carry raw coordinates in ``geometry`` or a prepared ``edges`` list.  With ``overlapping`` the members
    of a group (whose keys are column names then) may overlap; ``cell_size`` is the grid side that their edges meet on.
    """
    keys = _cols(by)
    if edges not in df.columns:
        df = df.withColumn(edges, polygon_edges(F.col(geometry)))

    if overlapping:
        return _with_attributes(df, keys, union_aggregate(df.select(*keys, edges), keys, edges=edges, snap_digits=snap_digits, cell_size=cell_size),
                                aggs, edges, with_bbox)

    def snapped(xc: Column, yc: Column) -> Column:
        return F.struct(F.round(xc, snap_digits).alias("x"), F.round(yc, snap_digits).alias("y"))

    def undirected(e: Column) -> Column:
        a, b = snapped(e["x1"], e["y1"]), snapped(e["x2"], e["y2"])
        return F.struct(F.least(a, b).alias("p"), F.greatest(a, b).alias("q"))

    members = df.select(*keys, F.array_sort(F.transform(edges, undirected)).alias("__m")).distinct()
    und = members.select(*keys, F.explode("__m").alias("__e")).select(*keys, F.col("__e.p").alias("__p"), F.col("__e.q").alias("__q"))
    und = und.filter(F.col("__p") != F.col("__q"))
    odd = und.groupBy(*keys, "__p", "__q").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") % 2 == 1)
    edge = F.struct(F.col("__p.x").alias("x1"), F.col("__p.y").alias("y1"),
                    F.col("__q.x").alias("x2"), F.col("__q.y").alias("y2"))
    geom = odd.groupBy(*keys).agg(F.sort_array(F.collect_list(edge)).alias(edges))
    return _with_attributes(df, keys, geom, aggs, edges, with_bbox)


def _with_attributes(df: DataFrame, keys: list, geom: DataFrame, aggs, edges: str, with_bbox: bool) -> DataFrame:
    """``geom`` (keys, edges) with the groups' aggregates and the boundary's box."""
    if aggs:
        attrs = df.groupBy(*keys).agg(*aggs)
        geom = geom.select(*[geom[k].alias(f"__k{i}") for i, k in enumerate(keys)], edges)
        same = [attrs[k].eqNullSafe(geom[f"__k{i}"]) for i, k in enumerate(keys)]  # a NULL key is a group too
        out = attrs.join(geom, same, "left").drop(*[f"__k{i}" for i in range(len(keys))])
    else:
        out = geom
    if with_bbox:
        out = out.withColumns(edges_bbox(edges))
    return out
