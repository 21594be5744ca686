"""Geometry queries beyond the reports, each next to its DuckDB oracle SQL.

The whole globe is covered by stretching the city model's square of [0, 100) over longitudes and latitudes, so incidents
and stations lie on both sides of the date line and around the poles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import planar_distance, polygon_edges, signed_area
from ..operators.dissolve import dissolve
from ..operators.spatial import spatial_join
from ..operators.union import rings
from ..session import scratch_path
from ..sources import ingest
from . import city_model as cm
from . import reports
from .oracle import _BLOCKS, _CODES, _INCOME, _PTS, _STATIONS, ORACLE_SQL


# --- nearest on the sphere ------------------------------------------------------------

def _on_globe(spark, d):
    inc, st = cm.incidents(spark, d), cm.stations(spark, d)
    inc = inc.select("incident_id", (F.col("lon") * 3.6 - 180.0).alias("lon"), (F.col("lat") * 1.8 - 90.0).alias("lat"))
    return inc, st.select("station_id", "division", (F.col("sx") * 3.6 - 180.0).alias("sx"), (F.col("sy") * 1.8 - 90.0).alias("sy"))


def q_nearest_k_sphere(spark, d):
    inc, st = _on_globe(spark, d)
    out = reports.k_nearest_stations(inc, st, 3, key="incident_id", x="lon", y="lat", station_x="sx", station_y="sy",
                                     station_key="station_id", use_sphere=True)
    return out.select("incident_id", "neighbor_rank", "station_id", F.round("distance", 3).alias("distance_m"))


def q_nearest_station_sphere(spark, d):
    inc, st = _on_globe(spark, d)
    out = reports.nearest_station_report(inc, st, key="incident_id", x="lon", y="lat", station_x="sx", station_y="sy",
                                         division="division", use_sphere=True)
    return out.select("division", "crime_count", F.round(F.col("average_distance") / 1000, 5).alias("average_km"))


_GLOBE = f"""WITH {_PTS}, {_STATIONS},
a AS (SELECT incident_id, x * CAST(3.6 AS DOUBLE) - 180 AS x, y * CAST(1.8 AS DOUBLE) - 90 AS y FROM pts),
b AS (SELECT station_id, division, sx * CAST(3.6 AS DOUBLE) - 180 AS sx, sy * CAST(1.8 AS DOUBLE) - 90 AS sy FROM st),
h AS (SELECT incident_id, station_id, division, pow(sin(radians(sy - y) / 2), 2)
             + cos(radians(y)) * cos(radians(sy)) * pow(sin(radians(sx - x) / 2), 2) AS h FROM a CROSS JOIN b),
d AS (SELECT incident_id, station_id, division, 2 * CAST(6371008 AS DOUBLE) * asin(sqrt(least(h, 1))) AS distance FROM h),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY incident_id ORDER BY distance, station_id) AS rn FROM d)
"""

# --- unions ---------------------------------------------------------------------------

REACH = 8.0  # half the side of a station's square


def _station_squares(spark, d):
    """A square around each station; those of a nation overlap at will."""
    st = cm.stations(spark, d).join(cm.table(spark, d, "supplier").select(F.col("s_suppkey").alias("station_id"), F.col("s_nationkey").alias("nation")),
                                    "station_id")
    x0, x1, y0, y1 = F.col("sx") - REACH, F.col("sx") + REACH, F.col("sy") - REACH, F.col("sy") + REACH
    corner = lambda x, y: F.array(F.round(x, 5), F.round(y, 5))
    ring = F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))
    return st.select("nation", F.array(F.array(ring)).alias("geometry"))


def _measured(spark, shapes, key, name):
    """Unions written as GeoJSON and read again: area, length of the boundary, outer rings less holes."""
    path = scratch_path(spark, name)
    ingest.write_geojson(rings(shapes), path)
    back = ingest.read_geojson(spark, path, spark.createDataFrame([], f"{key.name} {key.dataType.simpleString()}").schema, multi_line=False)
    edges = polygon_edges("geometry")
    length = F.aggregate(edges, F.lit(0.0), lambda a, e: a + planar_distance(e.x1, e.y1, e.x2, e.y2))
    n = F.aggregate("geometry", F.lit(0), lambda a, p: a + 2 - F.size(p))
    return back.select(key.name, F.round(signed_area("geometry"), 4).alias("area"), F.round(length, 4).alias("boundary"), n.cast("long").alias("euler"))


def q_dissolve_overlap(spark, d):
    shapes = dissolve(_station_squares(spark, d), "nation", overlapping=True, with_bbox=False)
    return _measured(spark, shapes, shapes.schema["nation"], "station-areas")


def q_dissolve_overlap_within(spark, d):
    # incidents inside any of a nation's overlapping squares, each once
    shapes = dissolve(_station_squares(spark, d), "nation", overlapping=True)
    pts = cm.incidents(spark, d).select("lon", "lat")
    return spatial_join(pts, shapes, "lon", "lat").groupBy("nation").agg(F.count(F.lit(1)).alias("crime_count"))


def q_dissolve_rings(spark, d):
    blocks = cm.census_blocks(spark, d).select("CITY", "geometry")
    shapes = dissolve(blocks, "CITY", overlapping=True, with_bbox=False)
    return _measured(spark, shapes, shapes.schema["CITY"], "city-outlines")


def _grown_blocks(spark, d):
    """Census blocks as the square of their zip grown by half a unit: the blocks of a zip are equal, those of neighbours overlap."""
    blocks = cm.census_blocks(spark, d)
    corner = F.array_min(F.transform(F.flatten(F.flatten("geometry")), lambda p: p[0])) - 0.5, F.array_min(
        F.transform(F.flatten(F.flatten("geometry")), lambda p: p[1])) - 0.5
    at = lambda i, j: F.array(corner[0] + 11.0 * i, corner[1] + 11.0 * j)
    return blocks.withColumn("geometry", F.array(F.array(F.array(at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0)))))


def q_income_crime_overlap(spark, d):
    return reports.income_crime_report(_grown_blocks(spark, d), cm.income(spark, d), cm.incidents(spark, d), "AMERICA", x="lon", y="lat",
                                       overlapping=True)


def q_top_bottom_profile_overlap(spark, d):
    return reports.descent_profile_one_pass(_grown_blocks(spark, d), cm.income(spark, d), cm.incidents(spark, d), cm.priority_codes(spark),
                                            "AMERICA", 3, x="lon", y="lat", code_col="code", codes_key="code", label_col="label",
                                            overlapping=True).withColumnRenamed("count", "crime_count")


def q_top_bottom_profile_overlap_two_pass(spark, d):
    return reports.descent_profile_report(q_income_crime_overlap(spark, d), cm.incidents(spark, d), _grown_blocks(spark, d), cm.priority_codes(spark),
                                          3, x="lon", y="lat", code_col="code", codes_key="code", label_col="label") \
        .withColumnRenamed("count", "crime_count")


# --- geometry functions in SQL text, boundary rule, one large document ------------------

def q_income_crime_sql(spark, d):
    cm.census_blocks(spark, d).createOrReplaceTempView("tessera_blocks")
    cm.income(spark, d).createOrReplaceTempView("tessera_income")
    cm.incidents(spark, d).createOrReplaceTempView("tessera_places")
    return reports.income_crime_report_sql(spark, "tessera_blocks", "tessera_income", "tessera_places", "AMERICA", x="lon", y="lat", cell_size=20.0)


def q_nearest_station_sql(spark, d):
    cm.incidents(spark, d).createOrReplaceTempView("tessera_places")
    cm.stations(spark, d).createOrReplaceTempView("tessera_stations")
    out = reports.nearest_station_report_sql(spark, "tessera_places", "tessera_stations", key="incident_id", x="lon", y="lat", station_x="sx",
                                             station_y="sy", division="division", pairs_view="tessera_pairs")
    return out.select("division", "crime_count", F.round("average_distance", 9).alias("average_distance"))


def q_within_boundary(spark, d):
    # incidents on a lattice of halves: many lie on edges and corners of the blocks, where two to eight meet
    key = F.col("o_orderkey")
    pts = cm.table(spark, d, "orders").select(((key * 7919) % 201 / 2).alias("lon"), ((key * 104729) % 201 / 2).alias("lat"))
    blocks = cm.census_blocks(spark, d).select("block_id", "geometry")
    counts = [spatial_join(pts, blocks, "lon", "lat", boundary=rule).groupBy("block_id").agg(F.count(F.lit(1)).alias(name))
              for rule, name in (("outside", "within_count"), ("inside", "covered_count"))]
    return counts[1].join(counts[0], "block_id", "left").select("block_id", F.coalesce("within_count", F.lit(0)).alias("within_count"), "covered_count")


def q_geojson_one_document(spark, d):
    # all incidents' customers as one FeatureCollection on one line, read again by several tasks
    features = cm.table(spark, d, "orders").select(F.concat(
        F.lit('{ "properties": '), F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.concat(F.lit('a "q\\{" } '), "o_orderpriority").alias("note"))),
        F.lit(', "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[['), F.col("o_orderkey"), F.lit(",0],["), F.col("o_orderkey"),
        F.lit(",1],["), F.col("o_orderkey") + 1, F.lit(",1],["), F.col("o_orderkey"), F.lit(",0]]]} }")).alias("f"))
    path = scratch_path(spark, "one-document")
    ingest.write_document(features, path, "f")
    back = ingest.read_geojson_document(spark, path, spark.createDataFrame([], "key long, note string").schema, split_bytes=1 << 18)
    return back.select("key", "note", "geometry_type", signed_area("geometry").alias("area"))


# Unions of axis-parallel squares by coordinate compression: cells between neighbouring coordinates, covered or not.
# Outer rings less holes is cells less neighbouring pairs plus full blocks of four.
def _compressed(squares: str, key: str) -> str:
    return f"""WITH {squares},
xs AS (SELECT {key}, x, lead(x) OVER (PARTITION BY {key} ORDER BY x) AS x2, row_number() OVER (PARTITION BY {key} ORDER BY x) AS i
       FROM (SELECT {key}, x0 AS x FROM sq UNION SELECT {key}, x1 FROM sq)),
ys AS (SELECT {key}, y, lead(y) OVER (PARTITION BY {key} ORDER BY y) AS y2, row_number() OVER (PARTITION BY {key} ORDER BY y) AS j
       FROM (SELECT {key}, y0 AS y FROM sq UNION SELECT {key}, y1 FROM sq)),
cell AS (SELECT DISTINCT xs.{key}, i, j, x, x2, y, y2 FROM xs JOIN ys ON xs.{key} = ys.{key} JOIN sq ON sq.{key} = xs.{key}
         AND sq.x0 <= x AND x2 <= sq.x1 AND sq.y0 <= y AND y2 <= sq.y1),
side AS (SELECT c.{key}, count(*) AS n, sum(CAST(c.x2 - c.x AS HUGEINT) * (c.y2 - c.y)) AS area,
                sum((r.i IS NULL)::INT * (c.y2 - c.y) + (l.i IS NULL)::INT * (c.y2 - c.y)
                    + (u.i IS NULL)::INT * (c.x2 - c.x) + (d.i IS NULL)::INT * (c.x2 - c.x)) AS boundary,
                count(r.i) + count(u.i) AS pairs, count(CASE WHEN r.i IS NOT NULL AND u.i IS NOT NULL AND q.i IS NOT NULL THEN 1 END) AS blocks
         FROM cell c LEFT JOIN cell r ON r.{key} = c.{key} AND r.i = c.i + 1 AND r.j = c.j LEFT JOIN cell l ON l.{key} = c.{key} AND l.i = c.i - 1 AND l.j = c.j
         LEFT JOIN cell u ON u.{key} = c.{key} AND u.i = c.i AND u.j = c.j + 1 LEFT JOIN cell d ON d.{key} = c.{key} AND d.i = c.i AND d.j = c.j - 1
         LEFT JOIN cell q ON q.{key} = c.{key} AND q.i = c.i + 1 AND q.j = c.j + 1 GROUP BY 1)
SELECT {key}, round(CAST(area AS DOUBLE) / 1e10, 4) AS area, round(CAST(boundary AS DOUBLE) / 1e5, 4) AS boundary, n - pairs + blocks AS euler FROM side"""


# in units of 1e-5, as whole numbers
_SQUARES = """sq AS (SELECT s_nationkey AS nation, ((s_suppkey * 15485863) % 1000000) * 10 + 3 - 800000 AS x0, ((s_suppkey * 15485863) % 1000000) * 10 + 3 + 800000 AS x1,
              ((s_suppkey * 32452843) % 1000000) * 10 + 1 - 800000 AS y0, ((s_suppkey * 32452843) % 1000000) * 10 + 1 + 800000 AS y1 FROM supplier)"""
_NATIONS = """sq AS (SELECT r_name AS CITY, (n_nationkey % 5) * 2000000 AS x0, (n_nationkey % 5) * 2000000 + 2000000 AS x1,
              (n_nationkey // 5) * 2000000 AS y0, (n_nationkey // 5) * 2000000 + 2000000 AS y1 FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_GROWN = f"""WITH {_PTS}, {_BLOCKS}, {_INCOME},
grown AS (SELECT *, (n % 5) * 20 + ((k // 2) % 2) * 10 - 0.5 AS x0, (n // 5) * 20 + (k // 4) * 10 - 0.5 AS y0 FROM blocks),
hit AS (SELECT incident_id, code, block_id, comm, city, zcta FROM pts JOIN grown ON x > x0 AND x < x0 + 11 AND y > y0 AND y < y0 + 11),
zips AS (SELECT zcta, comm, SUM(housing) AS housing, SUM(pop) AS population FROM blocks WHERE city = 'AMERICA' GROUP BY zcta, comm),
z AS (SELECT zips.*, median FROM zips JOIN inc ON CAST(zcta AS INTEGER) = zip),
c AS (SELECT comm, CAST(SUM(population) AS BIGINT) AS pop, CAST(SUM(housing * median) AS BIGINT) AS income FROM z GROUP BY comm),
m AS (SELECT hit.comm, COUNT(DISTINCT incident_id) AS crimes FROM hit JOIN z ON hit.zcta = z.zcta AND hit.comm = z.comm GROUP BY hit.comm),
q3 AS (SELECT c.comm AS COMM, CAST(crimes AS DOUBLE) / pop AS crimes_per_capita, CAST(income AS DOUBLE) / pop AS income_per_capita
       FROM c JOIN m ON c.comm = m.comm)
"""

GEO_QUERIES = {"nearest_k_sphere": q_nearest_k_sphere, "nearest_station_sphere": q_nearest_station_sphere,
               "dissolve_overlap": q_dissolve_overlap, "dissolve_overlap_within": q_dissolve_overlap_within, "dissolve_rings": q_dissolve_rings,
               "income_crime_overlap": q_income_crime_overlap, "top_bottom_profile_overlap": q_top_bottom_profile_overlap,
               "top_bottom_profile_overlap_two_pass": q_top_bottom_profile_overlap_two_pass, "income_crime_sql": q_income_crime_sql,
               "nearest_station_sql": q_nearest_station_sql, "within_boundary": q_within_boundary, "geojson_one_document": q_geojson_one_document}
GEO_SQL = {
    "nearest_k_sphere": _GLOBE + """SELECT incident_id, CAST(rn AS INTEGER) AS neighbor_rank, station_id, round(distance, 3) AS distance_m
FROM r WHERE rn <= 3""",
    "nearest_station_sphere": _GLOBE + """SELECT division, COUNT(*) AS crime_count, round(AVG(distance) / 1000, 5) AS average_km
FROM r WHERE rn = 1 GROUP BY division""",
    "dissolve_overlap": _compressed(_SQUARES, "nation"),
    "dissolve_rings": _compressed(_NATIONS, "CITY"),
    "dissolve_overlap_within": f"""WITH {_PTS}, {_STATIONS},
h AS (SELECT DISTINCT s_nationkey AS nation, incident_id FROM pts JOIN st ON x > sx - 8 AND x < sx + 8 AND y > sy - 8 AND y < sy + 8
      JOIN supplier ON s_suppkey = station_id)
SELECT nation, COUNT(*) AS crime_count FROM h GROUP BY nation""",
    "income_crime_overlap": _GROWN + "SELECT * FROM q3",
    "top_bottom_profile_overlap": _GROWN.rstrip() + f""", {_CODES},
chosen AS ((SELECT COMM, 'top' AS side FROM q3 ORDER BY income_per_capita DESC, COMM LIMIT 3)
           UNION ALL (SELECT COMM, 'bottom' AS side FROM q3 ORDER BY income_per_capita, COMM LIMIT 3))
SELECT side, label AS descent, COUNT(*) AS crime_count FROM hit JOIN chosen ON hit.comm = chosen.COMM LEFT JOIN codes ON codes.code = hit.code
GROUP BY side, label""",
}
GEO_SQL["income_crime_sql"] = ORACLE_SQL["income_crime_per_capita"]
GEO_SQL["nearest_station_sql"] = ORACLE_SQL["nearest_station"]
GEO_SQL["within_boundary"] = f"""WITH {_BLOCKS},
p AS (SELECT CAST((o_orderkey * 7919) % 201 AS DOUBLE) / 2 AS x, CAST((o_orderkey * 104729) % 201 AS DOUBLE) / 2 AS y FROM orders),
h AS (SELECT block_id, k % 2 AS t, x - ((n % 5) * 20 + ((k // 2) % 2) * 10) AS dx, y - ((n // 5) * 20 + (k // 4) * 10) AS dy FROM p CROSS JOIN blocks)
SELECT block_id, COUNT(*) FILTER (WHERE CASE WHEN t = 0 THEN 0 < dy AND dy < dx AND dx < 10 ELSE 0 < dx AND dx < dy AND dy < 10 END) AS within_count,
       COUNT(*) AS covered_count
FROM h WHERE CASE WHEN t = 0 THEN 0 <= dy AND dy <= dx AND dx <= 10 ELSE 0 <= dx AND dx <= dy AND dy <= 10 END GROUP BY block_id"""
GEO_SQL["geojson_one_document"] = """SELECT o_orderkey AS key, 'a "q\\{" } ' || o_orderpriority AS note, 'Polygon' AS geometry_type,
       CAST(-0.5 AS DOUBLE) AS area FROM orders"""
GEO_SQL["top_bottom_profile_overlap_two_pass"] = GEO_SQL["top_bottom_profile_overlap"]
