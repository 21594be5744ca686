"""Property tests: the column expressions agree with plain-Python brute force."""

import math

from hypothesis import given, settings, strategies as st

from tessera.functions import AGE_GROUPS, bucketize, polygon_edges, within
from tests.test_spatial import py_inside

coord = st.floats(min_value=-50, max_value=50, allow_nan=False, allow_infinity=False).map(lambda v: round(v, 3))


@st.composite
def star_polygon(draw):
    cx, cy = draw(coord), draw(coord)
    n = draw(st.integers(min_value=3, max_value=9))
    radii = draw(st.lists(st.floats(min_value=0.5, max_value=20), min_size=n, max_size=n))
    ring = [[cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)]
            for i, r in enumerate(radii)]
    return [[ring + [ring[0]]]]


@settings(max_examples=12, deadline=None)
@given(polys=st.lists(star_polygon(), min_size=1, max_size=4),
       pts=st.lists(st.tuples(coord, coord), min_size=1, max_size=40))
def test_within_matches_python_ray_cast(spark, polys, pts):
    rows = [(i, g, float(x), float(y)) for i, g in enumerate(polys) for x, y in pts]
    df = spark.createDataFrame(rows, "pid int, g array<array<array<array<double>>>>, x double, y double")
    got = [r[0] for r in df.select(within("x", "y", polygon_edges("g"))).collect()]
    assert got == [py_inside(x, y, g) for _, g, x, y in rows]


@settings(max_examples=10, deadline=None)
@given(ages=st.lists(st.one_of(st.none(), st.integers(min_value=-5, max_value=120)), min_size=1, max_size=50))
def test_bucketize_matches_case_rules(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(bucketize("age", AGE_GROUPS)).collect()]

    def rule(a):
        if a is None:
            return None
        if a < 18:
            return "<18"
        if 18 <= a <= 24:
            return "18-24"
        if 25 <= a <= 64:
            return "25-64"
        return ">64" if a > 64 else None

    assert got == [rule(a) for a in ages]
