"""Geometry functions inside SQL text agree with the column builders."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import planar_distance, polygon_edges, sphere_distance, within
from tessera.functions.sql import register_geometry_functions
from tessera.operators import dissolve
from tests.test_spatial import CONCAVE, TWO_PARTS, WITH_HOLE, fl

GEO = "array<array<array<array<double>>>>"


@pytest.fixture(scope="module")
def shapes(spark):
    register_geometry_functions(spark)
    open_ring = fl([[[[0, 0], [3, 0], [3, 3]]]])
    rows = [(1, CONCAVE), (2, WITH_HOLE), (3, TWO_PARTS), (4, open_ring), (5, None), (6, []), (7, fl([[[[1, 1]]]]))]
    df = spark.createDataFrame(rows, f"id int, geometry {GEO}")
    df.createOrReplaceTempView("shapes")
    return df


def test_edges_and_within(spark, shapes):
    r = random.Random(1)
    pts = spark.createDataFrame([(r.uniform(-1, 11), r.uniform(-1, 11)) for _ in range(200)], "x double, y double")
    pts.createOrReplaceTempView("places")
    sql = spark.sql("SELECT id, x, y, st_edges(geometry) AS edges, st_within(st_point(x, y), st_edges(geometry)) AS inside "
                    "FROM shapes CROSS JOIN places").collect()
    e = polygon_edges("geometry")
    own = shapes.crossJoin(pts).select("id", "x", "y", e.alias("edges"), within("x", "y", e).alias("inside")).collect()
    assert sorted(map(str, sql)) == sorted(map(str, own))


def test_distances(spark, shapes):
    row = spark.sql("SELECT st_distance(st_point(0, 0), st_point(3, 4)), st_distance_sphere(st_point(77.5946, 12.9716), st_point(78.9629, 20.5937)), "
                    "st_x(st_point(1, 2)), st_y(st_point(1, 2))").first()
    own = spark.range(1).select(planar_distance(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(4.0)),
                                sphere_distance(F.lit(77.5946), F.lit(12.9716), F.lit(78.9629), F.lit(20.5937))).first()
    assert row[0] == own[0] == 5.0 and math.isclose(row[1], own[1], rel_tol=1e-12) and row[2:] == (1.0, 2.0)


def test_union_is_that_of_the_operator(spark, shapes):
    box = lambda x, y: fl([[[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]])
    rows = [("a", box(i, j)) for i in range(4) for j in range(3) if (i, j) != (1, 1)] + [("a", box(0, 0)), ("b", box(9, 9)), (None, box(1, 1))]
    df = spark.createDataFrame(rows, f"g string, geometry {GEO}")
    df.createOrReplaceTempView("tiles")
    sql = {r["g"]: {tuple(e) for e in r["u"]} for r in spark.sql("SELECT g, st_union(collect_list(st_edges(geometry))) AS u FROM tiles GROUP BY g").collect()}
    own = {r["g"]: {tuple(e) for e in r["edges"]} for r in dissolve(df, "g").collect()}
    assert sql == own and len(sql["a"]) == 18


def test_cells_meet_every_point_inside(spark, shapes):
    r = random.Random(3)
    spark.createDataFrame([(i, r.uniform(-1, 11), r.uniform(-1, 11)) for i in range(500)], "p int, x double, y double").createOrReplaceTempView("places")
    every = spark.sql("SELECT id, p FROM shapes CROSS JOIN places WHERE st_within(st_point(x, y), st_edges(geometry))").collect()
    joined = spark.sql("""
        SELECT id, p FROM (SELECT id, edges, explode(cells) AS cell FROM (
            SELECT id, st_edges(geometry) AS edges, st_cells(st_edges(geometry), 2.5D) AS cells FROM shapes)) s
        JOIN (SELECT p, st_point(x, y) AS at, st_cell(st_point(x, y), 2.5D) AS cell FROM places) q ON s.cell = q.cell WHERE st_within(at, edges)""")
    assert sorted(joined.collect()) == sorted(every) and len(every) > 100
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_functions_are_inlined(spark, shapes):
    plan = spark.sql("SELECT st_within(st_point(1, 1), st_edges(geometry)) FROM shapes")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "aggregate(" in plan
