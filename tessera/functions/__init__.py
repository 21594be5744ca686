"""Scalar column builders: buckets, clean-up, geometry."""

from .buckets import AGE_GROUPS, Bucket, bucketize
from .cleaning import format_currency, parse_currency, parse_timestamp, ratio, words
from .geometry import (
    EARTH_RADIUS_M,
    crossings,
    edges_bbox,
    on_boundary,
    planar_distance,
    point,
    polygon_edges,
    sphere_distance,
    within,
)

__all__ = [
    "AGE_GROUPS", "Bucket", "bucketize",
    "format_currency", "parse_currency", "parse_timestamp", "ratio", "words",
    "EARTH_RADIUS_M", "crossings", "edges_bbox", "on_boundary", "planar_distance",
    "point", "polygon_edges", "sphere_distance", "within",
]
