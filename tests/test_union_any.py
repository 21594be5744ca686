"""Unions of polygons that overlap, their rings, the GeoJSON round trip, and one-pass Q4 on overlapping blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.geometry import polygon_edges, signed_area, within
from tessera.operators import dissolve, rings, union_aggregate
from tessera.operators.union import ring_coordinates
from tessera.plans import reports
from tessera.sources import ingest
from tests.test_spatial import fl, py_inside

GEO = "array<array<array<array<double>>>>"


def box(x, y, w, h):
    return fl([[[[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]]])


def shapes(spark, rows):
    return spark.createDataFrame(rows, f"g string, geometry {GEO}")


def made(spark, rows):
    return {r["g"]: r["geometry"] for r in rings(union_aggregate(shapes(spark, rows), "g")).collect()}


def area(geometry):
    return sum((a[0] * b[1] - b[0] * a[1]) / 2 for part in geometry for ring in part for a, b in zip(ring, ring[1:]))


def test_crossing_touching_nested_and_repeated_members(spark):
    rows = [("cross", box(0, 0, 10, 10)), ("cross", box(5, 5, 10, 10)), ("cross", box(5, 5, 10, 10)),
            ("frame", box(0, 0, 10, 2)), ("frame", box(0, 8, 10, 2)), ("frame", box(0, 0, 2, 10)), ("frame", box(8, 0, 2, 10)),
            ("tile", box(0, 0, 5, 5)), ("tile", box(5, 0, 5, 5)), ("corner", box(0, 0, 5, 5)), ("corner", box(5, 5, 5, 5)),
            ("nested", box(0, 0, 10, 10)), ("nested", box(2, 2, 3, 3)), ("nested", box(0, 0, 4, 4)), ("part", box(0, 0, 6, 4)), ("part", box(3, 0, 6, 4)),
            (None, box(0, 0, 1, 1)), ("none", None), ("flat", box(0, 0, 0, 5))]
    got = made(spark, rows)
    assert {k: len(v) for k, v in got.items()} == {"cross": 1, "frame": 1, "tile": 1, "corner": 2, "nested": 1, "part": 1, None: 1, "none": 0, "flat": 0}
    assert [len(p) for p in got["frame"]] == [2] and area(got["frame"]) == 64
    assert {k: area(v) for k, v in got.items() if k in ("cross", "tile", "corner", "nested", "part")} == {
        "cross": 175, "tile": 50, "corner": 50, "nested": 100, "part": 36}
    assert len(got["tile"][0][0]) == 5  # no vertex inside a straight run


def random_rows(seed, groups=3, n=14):
    """Star-shaped polygons, some with a hole, some self-crossing, with equal ones, corners on others' edges and long slivers."""
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        for _ in range(n):
            cx, cy, size = r.uniform(0, 60), r.uniform(0, 60), r.choice([2.0, 7.0, 20.0])
            k = r.randint(3, 9)
            turns = sorted(r.uniform(0, 2 * math.pi) for _ in range(k))
            if r.random() < .2:
                r.shuffle(turns)  # crosses itself
            ring = [[round(cx + size * r.uniform(.4, 1) * math.cos(a), 6), round(cy + size * r.uniform(.4, 1) * math.sin(a), 6)] for a in turns]
            poly = [ring + ring[:1]]
            if r.random() < .3:
                poly.append([[round(cx + (x - cx) * .4, 6), round(cy + (y - cy) * .4, 6)] for x, y in poly[0]][::-1])
            rows.append((f"g{g}", [poly]))
        rows += rows[-2:]
        rows.append((f"g{g}", box(0, 30, 60, .01)))
        rows += [(f"g{g}", box(i * 4, 50, 6, 6)) for i in range(4)]
    return rows


@pytest.mark.parametrize("seed,cell", [(1, None), (2, 3.0), (3, 200.0)])
def test_union_covers_what_any_member_covers(spark, seed, cell):
    rows = random_rows(seed)
    r = random.Random(seed + 50)
    places = [(i, r.uniform(-20, 80), r.uniform(-20, 80)) for i in range(1500)]
    union = union_aggregate(shapes(spark, rows), "g", cell_size=cell)
    pts = spark.createDataFrame(places, "id int, x double, y double")
    both = rings(union).withColumn("ringed", polygon_edges("geometry")).drop("geometry").join(union, "g").join(F.broadcast(pts))
    got = {(r["g"], r["id"]): (r["a"], r["b"]) for r in both.select("g", "id", within("x", "y", "edges").alias("a"), within("x", "y", "ringed").alias("b")).collect()}
    wrong = 0
    for g in ("g0", "g1", "g2"):
        members = [m for k, m in rows if k == g]
        for i, x, y in places:
            want = any(py_inside(x, y, m) for m in members)
            wrong += got[g, i] != (want, want)
    assert wrong == 0


def test_union_area_equals_a_fine_grid(spark):
    r = random.Random(4)
    rows = [("a", box(r.randrange(40), r.randrange(40), r.randrange(1, 15), r.randrange(1, 15))) for _ in range(40)]
    cells = {(x, y) for _, m in rows for x in range(int(m[0][0][0][0]), int(m[0][0][2][0])) for y in range(int(m[0][0][0][1]), int(m[0][0][2][1]))}
    out = rings(dissolve(shapes(spark, rows), "g", overlapping=True, with_bbox=False))
    row = out.select(signed_area("geometry").alias("area"), "geometry").first()
    assert row["area"] == len(cells)
    pairs = sum(((x + 1, y) in cells) + ((x, y + 1) in cells) for x, y in cells)
    fours = sum({(x + 1, y), (x, y + 1), (x + 1, y + 1)} <= cells for x, y in cells)
    assert sum(2 - len(p) for p in row["geometry"]) == len(cells) - pairs + fours


def test_rings_keep_touching_holes_and_parts_apart():
    ring = [(0, 0, 4, 0), (4, 0, 4, 4), (4, 4, 0, 4), (0, 4, 0, 0)]
    holes = [(1, 1, 1, 2), (1, 2, 2, 2), (2, 2, 2, 1), (2, 1, 1, 1), (2, 2, 2, 3), (2, 3, 3, 3), (3, 3, 3, 2), (3, 2, 2, 2)]
    got = ring_coordinates([tuple(map(float, e)) for e in ring + holes])
    assert len(got) == 1 and area(got) == 14 and len(got[0]) in (2, 3)
    assert ring_coordinates([]) == []


def test_aggregates_and_box_come_along(spark):
    rows = [("a", 1, box(0, 0, 2, 2)), ("a", 2, box(1, 1, 2, 2)), ("b", 5, box(9, 9, 1, 1))]
    df = spark.createDataFrame(rows, f"g string, n int, geometry {GEO}")
    got = dissolve(df, "g", aggs=[F.sum("n").alias("n")], overlapping=True).collect()
    assert {r["g"]: (r["n"], len(r["edges"]), r["x_max"]) for r in got} == {"a": (3, 8 + 4 - 4, 3.0), "b": (5, 4, 10.0)}


def test_empty_table(spark):
    assert dissolve(shapes(spark, []), "g", overlapping=True).count() == 0


def test_geojson_sink_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1, box(0, 0, 2, 2)), ('q"uote', None, box(0, 0, 1, 1) + box(5, 5, 1, 1)), (None, 3, None)],
                               f"name string, n int, geometry {GEO}")
    ingest.write_geojson(df, f"{tmp_dir}/out")
    back = ingest.read_geojson(spark, f"{tmp_dir}/out", spark.createDataFrame([], "name string, n int").schema, multi_line=False)
    assert sorted(map(str, back.select("name", "n", "geometry", "geometry_type").collect())) == sorted(
        map(str, df.withColumn("geometry_type", F.when(F.col("n") == 1, "Polygon").when(F.col("name").isNotNull(), "MultiPolygon")).collect()))


def test_one_pass_profile_equals_two_pass_on_overlapping_blocks(spark):
    r = random.Random(6)
    blocks = [(["LA", "LA", "X"][i % 3], str(i % 5), f"C{i % 4}", i + 1, 2 * i + 3, box(r.uniform(0, 30), r.uniform(0, 30), 12, 9)) for i in range(16)]
    blocks = spark.createDataFrame(blocks, f"CITY string, ZCTA10 string, COMM string, HOUSING10 int, POP_2010 int, geometry {GEO}")
    income = spark.createDataFrame([(i, 100 * i + 50) for i in range(4)], "`Zip Code` int, `Estimated Median Income` int")
    crimes = spark.createDataFrame([(r.uniform(0, 45), r.uniform(0, 45), r.choice("ABC")) for _ in range(600)], "LON double, LAT double, `Vict Descent` string")
    codes = spark.createDataFrame([("A", "a"), ("B", "b")], "`Vict Descent` string, `Vict Descent Full` string")
    ranking = reports.income_crime_report(blocks, income, crimes, "LA", overlapping=True)
    two = reports.descent_profile_report(ranking, crimes, blocks, codes, 1)
    one = reports.descent_profile_one_pass(blocks, income, crimes, codes, "LA", 1, overlapping=True)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())) and one.count() > 2


def test_work_follows_the_outline_not_the_overlaps(spark, monkeypatch):
    from tessera.operators import union

    r = random.Random(3)
    at = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(400)]
    seen = []
    pieces = union._pieces
    monkeypatch.setattr(union, "_pieces", lambda *a: seen.append(pieces(*a).count()) or pieces(*a))
    got = made(spark, [("a", box(x / 20, y / 20, 10, 10)) for x, y in at])["a"]
    covered = {(i, j) for x, y in at for i in range(x, x + 200) for j in range(y, y + 200)}
    assert area(got) == pytest.approx(len(covered) / 400)
    assert seen[0] < 6000  # each square crosses about 190 others: some 150,000 pieces if all are cut


def test_polygons_of_many_edges_are_cut_into_cells_of_few(spark):
    from tessera.operators.spatial import _cell_edges, plan_grid, polygon_cells, prepare_polygons

    ring = [[50 + 40 * math.cos(2 * math.pi * k / 900), 50 + 40 * math.sin(2 * math.pi * k / 900)] for k in range(900)]
    prepared = prepare_polygons(shapes(spark, [("c", [[ring + ring[:1]]])]))
    spec = plan_grid(prepared)
    cells = _cell_edges(polygon_cells(prepared, spec), spec).select(F.size("__own").alias("n"), "__whole").collect()
    assert spec.broadcast and max(c["n"] for c in cells) < 200 and sum(c["__whole"] for c in cells) > 300
