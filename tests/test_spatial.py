import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import on_boundary, planar_distance, polygon_edges, sphere_distance, within
from tessera.operators import dissolve, plan_grid, prepare_polygons, spatial_join


def py_inside(px, py, multipolygon):
    """Brute-force even-odd ray cast over every ring (the reference semantics)."""
    n = 0
    for poly in multipolygon:
        for ring in poly:
            pts = ring if ring[0] == ring[-1] else ring + [ring[0]]
            for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
                if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                    n += 1
    return n % 2 == 1


def fl(g):
    """Coordinates as floats (Spark's double arrays reject Python ints)."""
    return [[[[float(c) for c in p] for p in ring] for ring in poly] for poly in g]


def mp(*rings):
    return fl([[list(map(list, r)) for r in rings]])


CONCAVE = mp([(0, 0), (10, 0), (10, 10), (5, 4), (0, 10), (0, 0)])
WITH_HOLE = mp([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(3, 3), (7, 3), (7, 7), (3, 7), (3, 3)])
TWO_PARTS = fl([[[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]]])


def test_within_concave_hole_multipart(spark):
    cases = [(CONCAVE, 5, 6, False), (CONCAVE, 5, 2, True), (CONCAVE, 1, 8, True),
             (WITH_HOLE, 5, 5, False), (WITH_HOLE, 1, 1, True), (WITH_HOLE, 20, 5, False),
             (TWO_PARTS, 1, 1, True), (TWO_PARTS, 5.5, 5.5, True), (TWO_PARTS, 3.5, 3.5, False),
             (CONCAVE, 2, 4.0, True)]  # ray through the vertex height of (5, 4)
    df = spark.createDataFrame([(g, float(x), float(y)) for g, x, y, _ in cases],
                               "g array<array<array<array<double>>>>, x double, y double")
    got = [r[0] for r in df.select(within("x", "y", polygon_edges("g"))).collect()]
    assert got == [c[3] for c in cases]
    assert got == [py_inside(x, y, g) for g, x, y, _ in cases]


def test_on_boundary(spark):
    df = spark.createDataFrame([(WITH_HOLE, 10.0, 5.0), (WITH_HOLE, 3.0, 5.0), (WITH_HOLE, 1.0, 1.0)],
                               "g array<array<array<array<double>>>>, x double, y double")
    got = [r[0] for r in df.select(on_boundary("x", "y", polygon_edges("g"), 1e-9)).collect()]
    assert got == [True, True, False]


def test_distances(spark):
    df = spark.createDataFrame([(12.9716, 77.5946, 20.5937, 78.9629)], "lat1 double, lon1 double, lat2 double, lon2 double")
    km = df.select(sphere_distance("lon1", "lat1", "lon2", "lat2") / 1000).first()[0]
    assert abs(km - 859.94) < 0.01
    d = df.select(planar_distance(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(4.0))).first()[0]
    assert d == 5.0


def _random_polygons(rng, n, span=100.0):
    polys = []
    for i in range(n):
        cx, cy = rng.uniform(0, span), rng.uniform(0, span)
        r = rng.choice([0.5, 2.0, 8.0, 40.0])  # mixes sizes so several grid levels are used
        k = rng.randint(3, 9)
        angs = sorted(rng.uniform(0, 2 * math.pi) for _ in range(k))
        ring = [[cx + r * rng.uniform(0.3, 1.0) * math.cos(a), cy + r * rng.uniform(0.3, 1.0) * math.sin(a)] for a in angs]
        ring.append(ring[0])
        polys.append((i, [[ring]]))
    return polys


def test_grid_join_equals_brute_force(spark):
    rng = random.Random(7)
    polys = _random_polygons(rng, 60)
    pts = [(j, rng.uniform(-5, 105), rng.uniform(-5, 105)) for j in range(3000)]
    pdf = spark.createDataFrame(polys, "pid int, geometry array<array<array<array<double>>>>")
    qdf = spark.createDataFrame(pts, "id int, x double, y double")
    expect = sorted((j, i) for j, x, y in pts for i, g in polys if py_inside(x, y, g))
    for cell in (None, 1.0, 25.0):
        got = sorted((r["id"], r["pid"]) for r in spatial_join(qdf, pdf, "x", "y", cell_size=cell).collect())
        assert got == expect, f"cell_size={cell}"
    spec = plan_grid(prepare_polygons(pdf), 1.0, max_cells=16)
    assert len(spec.levels) > 1


def test_left_join_keeps_unmatched(spark):
    rng = random.Random(3)
    polys = _random_polygons(rng, 20)
    pts = [(j, rng.uniform(0, 100), rng.uniform(0, 100)) for j in range(500)]
    pdf = spark.createDataFrame(polys, "pid int, geometry array<array<array<array<double>>>>")
    qdf = spark.createDataFrame(pts, "id int, x double, y double")
    expect = []
    for j, x, y in pts:
        hits = [i for i, g in polys if py_inside(x, y, g)]
        expect += [(j, i) for i in hits] or [(j, -1)]
    for cell in (2.0, 50.0):   # several grid levels, then a single level
        got = sorted((r["id"], -1 if r["pid"] is None else r["pid"])
                     for r in spatial_join(qdf, pdf, "x", "y", how="left", cell_size=cell).collect())
        assert got == sorted(expect)


def _square(x, y, s=1.0):
    x, y = float(x), float(y)
    return [[[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]]


def test_dissolve_tiles_hole_and_snapping(spark):
    third = 1.0 / 3.0
    rows = []
    # 2x2 unit tiles -> one 2x2 square whose boundary is 8 unit edges
    for i in range(2):
        for j in range(2):
            rows.append(("A", [_square(i, j)]))
    # a 3x3 ring of tiles around a hole (the centre tile is missing)
    for i in range(3):
        for j in range(3):
            if (i, j) != (1, 1):
                rows.append(("H", [_square(10 + i, j)]))
    # coordinates that agree only after rounding
    rows.append(("S", [[[[0.0, 20.0], [third * 3, 20.0], [1.0, 21.0], [0.0, 21.0], [0.0, 20.0]]]]))
    rows.append(("S", [[[[1.0 + 1e-12, 20.0], [2.0, 20.0], [2.0, 21.0], [1.0, 21.0 - 1e-12], [1.0 + 1e-12, 20.0]]]]))
    # disjoint tiles stay two parts
    rows.append(("D", [_square(30, 0)]))
    rows.append(("D", [_square(33, 0)]))
    df = spark.createDataFrame(rows, "comm string, geometry array<array<array<array<double>>>>")
    out = {r["comm"]: r for r in dissolve(df, "comm").collect()}
    assert len(out["A"]["edges"]) == 8
    assert len(out["H"]["edges"]) == 12 + 4
    assert len(out["S"]["edges"]) == 6
    assert len(out["D"]["edges"]) == 8
    pts = spark.createDataFrame([(0.5, 0.5), (11.5, 1.5), (10.5, 0.5), (1.5, 20.5), (31.5, 0.5), (30.5, 0.5)],
                                "x double, y double")
    got = sorted((r["x"], r["comm"]) for r in spatial_join(pts, dissolve(df, "comm"), "x", "y").collect())
    assert got == [(0.5, "A"), (1.5, "S"), (10.5, "H"), (30.5, "D")]


def test_dissolve_membership_matches_any_block(spark):
    rng = random.Random(11)
    rows = [(f"c{(i // 4) % 3}", [_square(i % 4, i // 4)]) for i in range(16)]
    df = spark.createDataFrame(rows, "comm string, geometry array<array<array<array<double>>>>")
    pts = [(j, rng.uniform(0, 4), rng.uniform(0, 4)) for j in range(400)]
    qdf = spark.createDataFrame(pts, "id int, x double, y double")
    via_union = sorted((r["id"], r["comm"]) for r in spatial_join(qdf, dissolve(df, "comm"), "x", "y").collect())
    blocks = spark.createDataFrame(rows, "comm string, geometry array<array<array<array<double>>>>")
    via_blocks = sorted((r["id"], r["comm"]) for r in spatial_join(qdf, blocks, "x", "y").collect())
    assert via_union == via_blocks


def test_shuffle_path_beyond_broadcast_limit(spark):
    # max_broadcast_bytes=0: the cell table is not broadcast; both sides shuffle on the cell key
    rng = random.Random(21)
    polys = _random_polygons(rng, 30)
    pts = [(j, rng.uniform(0, 100), rng.uniform(0, 100)) for j in range(800)]
    pdf = spark.createDataFrame(polys, "pid int, geometry array<array<array<array<double>>>>")
    qdf = spark.createDataFrame(pts, "id int, x double, y double")
    expect = sorted((j, i) for j, x, y in pts for i, g in polys if py_inside(x, y, g))
    joined = spatial_join(qdf, pdf, "x", "y", cell_size=2.0, max_broadcast_bytes=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan or "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert sorted((r["id"], r["pid"]) for r in joined.collect()) == expect


def test_wide_polygon_columns_are_not_broadcast(spark):
    from tessera.operators.spatial import plan_grid, prepare_polygons

    square = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]]
    kind = "gid long, note string, geometry array<array<array<array<double>>>>"
    points = spark.createDataFrame([(1, 0.5, 0.5)], "pid long, x double, y double")
    for note, fits in (("short", True), ("w" * 20_000, False)):
        polygons = spark.createDataFrame([(1, note, square)], kind)
        assert plan_grid(prepare_polygons(polygons), max_broadcast_bytes=10_000).broadcast == fits
        joined = spatial_join(points, polygons, strategy="BROADCAST", max_broadcast_bytes=10_000)
        assert joined.select("pid", "gid").collect() == [(1, 1)]


def test_clipped_cells_and_whole_cells_keep_every_match(spark):
    """One large many-sided polygon with a hole over small cells: most cells are whole, the others hold few edges."""
    ring = [[50 + 40 * math.cos(2 * math.pi * i / 400), 50 + 40 * math.sin(2 * math.pi * i / 400)] for i in range(400)]
    hole = [[50 + 15 * math.cos(2 * math.pi * i / 90), 50 + 15 * math.sin(2 * math.pi * i / 90)] for i in range(90)]
    g = [[ring + ring[:1], hole + hole[:1]]]
    rng = random.Random(2)
    pts = [(j, rng.uniform(0, 100), rng.uniform(0, 100)) for j in range(4000)]
    pdf = spark.createDataFrame([(1, g)], "pid int, geometry array<array<array<array<double>>>>")
    qdf = spark.createDataFrame(pts, "id int, x double, y double")
    want = sorted(j for j, x, y in pts if py_inside(x, y, g))
    for how in ("inner", "left"):
        out = spatial_join(qdf, pdf, "x", "y", how=how, cell_size=2.0, max_cells=4096)
        assert sorted(r["id"] for r in out.where("pid is not null").collect()) == want
    from tessera.operators.spatial import _cell_edges, polygon_cells
    prepared = prepare_polygons(pdf)
    spec = plan_grid(prepared, 2.0, max_cells=4096)
    cells = _cell_edges(polygon_cells(prepared, spec, 4096), spec)
    assert cells.where("__whole").count() > 800 and cells.agg(F.max(F.size("__own"))).first()[0] < 60


@pytest.mark.parametrize("strategy", ["MERGE", "SHUFFLE_HASH"])
def test_hot_cell_is_dealt_over_tasks(spark, strategy):
    rows = spark.range(40_000).select("id", (F.col("id") % 97 / 100 + 5).alias("x"), (F.col("id") % 89 / 100 + 5).alias("y"))
    squares = spark.createDataFrame([(i, mp([(10 * i, 0), (10 * i + 10, 0), (10 * i + 10, 10), (10 * i, 10), (10 * i, 0)])) for i in range(9)],
                                    "pid int, geometry array<array<array<array<double>>>>")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = spatial_join(rows, squares, "x", "y", cell_size=10.0, strategy=strategy)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(sizes) == 40_000 and out.agg(F.min("pid"), F.max("pid")).first() == (0, 0)
    assert "__psalt" in plan and len(sizes) > 4 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


def test_boundary_rules(spark):
    square = mp([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)])
    slope = mp([(0.1, 0.1), (0.4, 0.7), (0.7, 0.1), (0.1, 0.1)])
    cases = [(square, 0, 0, "edge"), (square, 10, 10, "edge"), (square, 5, 10, "edge"), (square, 4, 5, "edge"), (square, 5, 5, "out"), (square, 5, 3, "in"),
             (square, 10.000001, 5, "out"), (square, 9.999999, 5, "in"), (slope, 0.2, 0.3, "edge"), (slope, 0.3, 0.5, "edge"), (slope, 0.2, 0.300001, "out"),
             (slope, 0.4, 0.7, "edge"), (slope, 0.4, 0.1, "edge"), (slope, 0.4, 0.2, "in")]
    df = spark.createDataFrame([(g, float(x), float(y), k) for g, x, y, k in cases], "g array<array<array<array<double>>>>, x double, y double, kind string")
    e = polygon_edges("g")
    for r in df.select("x", "y", "kind", on_boundary("x", "y", e).alias("b"), within("x", "y", e, "outside").alias("o"), within("x", "y", e, "inside").alias("i")).collect():
        assert (r["b"], r["o"], r["i"]) == {"edge": (True, False, True), "in": (False, True, True), "out": (False, False, False)}[r["kind"]], r
    with pytest.raises(ValueError):
        within("x", "y", e, "sometimes")


def test_boundary_rule_in_joins(spark):
    squares = spark.createDataFrame([(1, mp([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)])), (2, mp([(10, 0), (20, 0), (20, 10), (10, 10), (10, 0)]))],
                                    "pid int, geometry array<array<array<array<double>>>>")
    pts = spark.createDataFrame([(1, 10.0, 5.0), (2, 0.0, 0.0), (3, 20.0, 10.0), (4, 5.0, 5.0), (5, 10.0, 10.0)], "id int, x double, y double")
    got = {rule: sorted((r["id"], r["pid"]) for r in spatial_join(pts, squares, "x", "y", boundary=rule, cell_size=c, how=how).where("pid is not null").collect())
           for rule, c, how in (("outside", 10.0, "inner"), ("inside", 3.0, "left"))}
    assert got == {"outside": [(4, 1)], "inside": [(1, 1), (1, 2), (2, 1), (3, 2), (4, 1), (5, 1), (5, 2)]}
