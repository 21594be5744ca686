"""Unions of repeated polygons and NULL groups; grids planned for other polygons."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.dissolve import dissolve
from tessera.operators.spatial import plan_grid, prepare_polygons, spatial_join
from tessera.plans.reports import community_income


def ring(x, y, side=10.0, turn=0, back=False):
    pts = [[x, y], [x + side, y], [x + side, y + side], [x, y + side]]
    pts = [[float(a), float(b)] for a, b in pts[turn:] + pts[:turn]]
    pts = pts[::-1] if back else pts
    return [[pts + pts[:1]]]


GEO = "array<array<array<array<double>>>>"


def test_repeated_polygons_count_once(spark):
    rows = [("a", 1, ring(0, 0)), ("a", 2, ring(0, 0)), ("a", 3, ring(0, 0, turn=2, back=True)), ("a", 4, ring(10, 0))]
    out = dissolve(spark.createDataFrame(rows, f"g string, n int, geometry {GEO}"), "g", aggs=[F.sum("n").alias("n")]).collect()
    assert len(out) == 1 and out[0]["n"] == 10
    assert len(out[0]["edges"]) == 6 and (out[0]["x_min"], out[0]["x_max"]) == (0.0, 20.0)


def test_null_group_keeps_its_geometry(spark):
    rows = [(None, ring(0, 0)), (None, ring(10, 0)), ("b", ring(50, 50))]
    out = dissolve(spark.createDataFrame(rows, f"g string, geometry {GEO}"), "g", aggs=[F.count(F.lit(1)).alias("n")])
    assert {r["g"]: (r["n"], len(r["edges"])) for r in out.collect()} == {None: (2, 6), "b": (1, 4)}


def test_repeated_income_zip_keeps_the_community(spark):
    blocks = spark.createDataFrame([("LA", "1", "A", 2, 5, ring(0, 0)), ("LA", "2", "A", 3, 7, ring(10, 0))],
                                   f"CITY string, ZCTA10 string, COMM string, HOUSING10 int, POP_2010 int, geometry {GEO}")
    income = spark.createDataFrame([(1, 10), (1, 20), (2, 30)], "`Zip Code` int, `Estimated Median Income` int")
    out = community_income(blocks, income, "LA").collect()
    assert [(r["COMM"], r["comm_population"], r["comm_income"], len(r["edges"])) for r in out] == [("A", 17, 150, 6)]


def test_foreign_grid_is_refused(spark):
    small = prepare_polygons(spark.createDataFrame([(1, ring(0, 0, 1.0))], f"id int, geometry {GEO}"))
    large = prepare_polygons(spark.createDataFrame([(1, ring(0, 0, 900.0))], f"id int, geometry {GEO}"))
    points = spark.createDataFrame([(5.0, 5.0)], "x double, y double")
    with pytest.raises(Exception, match="grid level"):
        spatial_join(points, large, spec=plan_grid(small)).collect()
