"""Registered queries over the driver's tables and their DuckDB oracle SQL.

Each query reads whole tables (or data Spark derives from them) and returns a lazy
DataFrame.  The oracle computes the same answer independently in plain SQL: the
geometry there is closed-form (which square / triangle holds a point), so it
checks the grid join, the ray cast and the dissolve rather than repeating them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.cleaning import INCIDENT_TS_FORMAT, format_currency, parse_currency, ratio
from ..functions.geometry import planar_distance, sphere_distance, ring_area
from ..operators.dissolve import dissolve
from ..operators.relational import code_lookup, word_count
from ..operators.spatial import spatial_join
from ..operators.strategy import SUPPORTED_STRATEGIES, broadcast_if_bounded
from ..session import scratch_path
from ..sources import ingest
from . import city_model as cm
from . import reports
from .geo_queries import GEO_QUERIES

CITY = "AMERICA"          # region playing the city of the reports
DEPARTMENT = "NATION_1"   # nation playing "Dep A" in the course exercises
CELL = 10.0               # grid side for the census geometry (block size)
DIMENSION_ROWS = 100_000  # dimension tables (nation, region) are broadcast only up to this many rows


# --- Spark side ---------------------------------------------------------------------

def q_age_bucket_count(spark, d):
    part = cm.table(spark, d, "part")
    return reports.age_group_report(part, desc_col="p_type", age_col="p_size", needle="A",
                                    label="age_group", name="crime_count")


def q_age_bucket_count_lineitem(spark, d):
    li = cm.table(spark, d, "lineitem")
    return reports.age_group_report(li, desc_col="l_returnflag", age_col="l_quantity", needle="R",
                                    label="age_group", name="crime_count")


def _precinct_incidents(spark, d):
    inc = cm.incidents(spark, d)
    cust = cm.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = cm.table(spark, d, "nation").select("n_nationkey", "n_name")
    return (inc.join(cust, inc.cust == cust.c_custkey)
            .join(broadcast_if_bounded(nation, DIMENSION_ROWS), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("occurred", F.col("n_name").alias("area_name"), "status"))


_OPEN = ("O", "P")


def q_closed_rate_rank(spark, d):
    return reports.closed_case_report(_precinct_incidents(spark, d), date_col="occurred", area_col="area_name",
                                      status_col="status", open_values=_OPEN, rank="case_rank")


def q_closed_rate_rank_rowwise(spark, d):
    return reports.closed_case_report(_precinct_incidents(spark, d), date_col="occurred", area_col="area_name",
                                      status_col="status", open_values=_OPEN, null_is_closed=True,
                                      rank="case_rank")


def _with_missing_status(spark, d):
    """The incidents with no status where the day of the month divides by three."""
    known = F.day("occurred") % 3 != 0
    return _precinct_incidents(spark, d).withColumn("status", F.when(known, F.col("status")))


def q_null_status_rate(spark, d):
    return reports.closed_case_report(_with_missing_status(spark, d), date_col="occurred", area_col="area_name",
                                      status_col="status", open_values=_OPEN, rank="case_rank")


def q_null_status_rate_rowwise(spark, d):
    return reports.closed_case_report(_with_missing_status(spark, d), date_col="occurred", area_col="area_name",
                                      status_col="status", open_values=_OPEN, null_is_closed=True, rank="case_rank")


def q_closed_rate_rank_sql(spark, d):
    _precinct_incidents(spark, d).createOrReplaceTempView("tessera_incidents")
    return reports.closed_case_report_sql(spark, "tessera_incidents", date_col="occurred", area_col="area_name",
                                          status_col="status", open_values=_OPEN, rank="case_rank")


def q_closed_rate_rank_parquet(spark, d):
    path = scratch_path(spark, "incidents-parquet")
    ingest.write_parquet(_precinct_incidents(spark, d), path)
    back = ingest.read_parquet(spark, path)
    return reports.closed_case_report(back, date_col="occurred", area_col="area_name",
                                      status_col="status", open_values=_OPEN, rank="case_rank")


def q_currency_clean(spark, d):
    o = cm.table(spark, d, "orders")
    txt = o.select("o_orderkey", format_currency(F.floor("o_totalprice")).alias("price_text"))
    return txt.withColumn("price_int", parse_currency("price_text", "bigint"))


def q_dirty_text_clean(spark, d):
    # currency and timestamp text that does not parse, is empty or missing; a divisor of zero
    key = F.col("o_orderkey")
    price = (F.when(key % 4 == 0, format_currency(F.floor("o_totalprice"))).when(key % 4 == 1, F.lit("n/a"))
             .when(key % 4 == 2, F.lit("")))
    when = F.when(key % 3 == 0, F.lit("unknown")).when(key % 3 == 1, F.date_format("o_orderdate", INCIDENT_TS_FORMAT))
    raw = cm.table(spark, d, "orders").select("o_orderkey", price.alias("price"), when.alias("DATE OCC"),
                                              (key % 2).alias("people"))
    cleaned = ingest.clean_incidents(ingest.clean_income(raw, "price"), ts_columns=("DATE OCC",))
    return cleaned.select("o_orderkey", "price", F.col("`DATE OCC`").cast("timestamp_ntz").alias("occurred"),
                          ratio("o_orderkey", "people").alias("per_person"))


def q_missing_coordinates(spark, d):
    inc = cm.incidents(spark, d)
    key = F.col("incident_id")
    holes = inc.select("incident_id", F.when(key % 5 != 0, F.col("lon")).alias("LON"), F.when(key % 11 != 0, F.col("lat")).alias("LAT"))
    return ingest.drop_missing_coordinates(holes)


def q_code_table_csv(spark, d):
    # the code table as it ships: a CSV file that starts with a byte-order mark; one code is not in it
    code = F.col("o_orderpriority")
    codes = cm.table(spark, d, "orders").where(code != "4-NOT SPECIFIED").select(
        code.alias("\ufeffcode"), F.concat(F.lit("Label, "), F.lower(code)).alias("label")).distinct()
    path = scratch_path(spark, "codes-csv")
    ingest.write_csv(codes, path)
    out = code_lookup(cm.incidents(spark, d).select("code"), ingest.read_csv(spark, path), "code", "code", "label")
    return out.groupBy(F.col("label").alias("priority_label")).agg(F.count(F.lit(1)).alias("crime_count"))


def q_ts_parse(spark, d):
    o = cm.table(spark, d, "orders")
    raw = o.select("o_orderkey", F.date_format("o_orderdate", INCIDENT_TS_FORMAT).alias("DATE OCC"),
                   F.col("o_orderstatus").alias("AREA "))
    cleaned = ingest.clean_incidents(raw, ts_columns=("DATE OCC",))
    occurred = F.col("`DATE OCC`").cast("timestamp_ntz")
    return cleaned.select("o_orderkey", occurred.alias("occurred"), F.year(occurred).alias("occurred_year"),
                          F.col("AREA").alias("area"))


_BLOCK_PROPS = "block_id long, COMM string, CITY string, ZCTA10 string, HOUSING10 long, POP_2010 long"


def _write_blocks_geojson(spark, d):
    """Census blocks as GeoJSON, one Feature per line; returns the path."""
    blocks = cm.census_blocks(spark, d)
    # Triangles t=0 are written as Polygon, t=1 as a one-part MultiPolygon.
    is_poly = (F.col("block_id") % 2) == 0
    geom = F.struct(F.when(is_poly, F.lit("Polygon")).otherwise(F.lit("MultiPolygon")).alias("type"),
                    F.when(is_poly, F.to_json(F.col("geometry")[0])).otherwise(F.to_json("geometry")).alias("c"))
    feature = F.format_string('{"type":"Feature","properties":%s,"geometry":{"type":"%s","coordinates":%s}}',
                              F.to_json(F.struct("block_id", "COMM", "CITY", "ZCTA10", "HOUSING10", "POP_2010")),
                              geom["type"], geom["c"])
    # A GeoJSON text sequence, one Feature per line: splittable, and nothing is grouped.
    lines = blocks.select(feature.alias("value"))
    path = scratch_path(spark, "blocks-geojson")
    lines.write.mode("overwrite").text(path)
    return path


def _blocks_via_geojson(spark, d):
    props = spark.createDataFrame([], _BLOCK_PROPS).schema
    return ingest.read_geojson(spark, _write_blocks_geojson(spark, d), props, multi_line=False)


def q_geojson_features(spark, d):
    back = _blocks_via_geojson(spark, d)
    return back.select("block_id", "COMM", "CITY", "ZCTA10", "POP_2010", "geometry_type",
                       F.size(F.flatten(F.flatten("geometry"))).alias("n_vertices"),
                       ring_area("geometry").alias("area"),
                       F.array_min(F.transform(F.flatten(F.flatten("geometry")), lambda p: p[0])).alias("x_min"),
                       F.array_min(F.transform(F.flatten(F.flatten("geometry")), lambda p: p[1])).alias("y_min"))


def q_geojson_discovered(spark, d):
    # the property names and types come from the file itself
    back = ingest.read_geojson(spark, _write_blocks_geojson(spark, d), multi_line=False)
    return back.select("block_id", "COMM", "CITY", "ZCTA10", "HOUSING10", "POP_2010", "geometry_type")


def q_income_crime_per_capita_geojson(spark, d):
    blocks = _blocks_via_geojson(spark, d).drop("geometry_type")
    return reports.income_crime_report(blocks, cm.income(spark, d), cm.incidents(spark, d), CITY, x="lon", y="lat",
                                       cell_size=2 * CELL)


def q_closed_rate_rank_csv(spark, d):
    # the incident file as it ships: CSV with a header, 12-hour timestamp text and an
    # "AREA " column whose name ends in a space; read as declared, then cleaned
    raw = _precinct_incidents(spark, d).select(
        F.date_format("occurred", INCIDENT_TS_FORMAT).alias("DATE OCC"), F.col("area_name").alias("AREA "),
        F.col("status").alias("Status Desc"))
    path = scratch_path(spark, "incidents-csv")
    ingest.write_csv(raw, path, header=True)
    declared = "`DATE OCC` string, `AREA ` string, `Status Desc` string"
    crimes = ingest.clean_incidents(ingest.read_csv(spark, path, declared), ts_columns=("DATE OCC", "Date Rptd"))
    return reports.closed_case_report(crimes, date_col="DATE OCC", area_col="AREA", status_col="Status Desc",
                                      open_values=_OPEN, rank="case_rank")


def q_csv_roundtrip(spark, d):
    s = cm.table(spark, d, "supplier")
    n = cm.table(spark, d, "nation")
    src = s.join(broadcast_if_bounded(n, DIMENSION_ROWS), s.s_nationkey == n.n_nationkey).select(
        "s_suppkey", "s_name", "s_acctbal", F.concat_ws(", ", "s_name", "n_name").alias("location"))
    path = scratch_path(spark, "supplier-csv")
    ingest.write_csv(src, path, header=True)
    return ingest.read_csv(spark, path, "s_suppkey long, s_name string, s_acctbal double, location string")


def q_csv_no_header_schema(spark, d):
    c = cm.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    path = scratch_path(spark, "employees-csv")
    ingest.write_csv(c, path, header=False)
    return ingest.read_csv_no_header(spark, path, "id long, name string, salary double, dep_id int")


def q_word_count(spark, d):
    docs = cm.table(spark, d, "documents")
    return word_count(docs, "text").withColumnRenamed("count", "word_count")


def q_text_file_word_count(spark, d):
    docs = cm.table(spark, d, "documents")
    path = scratch_path(spark, "documents-text")
    docs.select("text").write.mode("overwrite").text(path)
    return reports.text_word_count(ingest.read_text_lines(spark, path)).withColumnRenamed("count", "word_count")


def _employees(spark, d):
    return cm.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("salary"),
        F.col("c_nationkey").alias("dep_id"), (F.col("c_nationkey") * 100.0).alias("bonus"))


def _departments(spark, d):
    return cm.table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def q_bottom_k(spark, d):
    s = cm.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                              F.col("s_acctbal").alias("salary"))
    return reports.bottom_paid(s, 5)


def q_top_k_in_group(spark, d):
    return reports.top_paid_in_department(_employees(spark, d), _departments(spark, d), DEPARTMENT, 3)


def q_top_k_in_group_sql(spark, d):
    _employees(spark, d).createOrReplaceTempView("tessera_employees")
    _departments(spark, d).createOrReplaceTempView("tessera_departments")
    return reports.top_paid_in_department_sql(spark, "tessera_employees", "tessera_departments", DEPARTMENT, 3)


def q_yearly_income(spark, d):
    return reports.yearly_income(_employees(spark, d))


def q_yearly_income_udf(spark, d):
    return reports.yearly_income_pandas(_employees(spark, d))


def q_code_lookup(spark, d):
    inc = cm.incidents(spark, d).select("incident_id", "code")
    out = code_lookup(inc, cm.priority_codes(spark), "code", "code", "label")
    return out.groupBy(F.col("label").alias("priority_label")).agg(F.count(F.lit(1)).alias("crime_count"))


def q_point_distance(spark, d):
    inc = cm.incidents(spark, d)
    return inc.select("incident_id", F.round(planar_distance("lon", "lat", F.lit(50.0), F.lit(50.0)), 9).alias("distance"))


def q_haversine(spark, d):
    inc = cm.incidents(spark, d)
    lon = F.col("lon") - F.lit(50.0)
    lat = (F.col("lat") - F.lit(50.0)) * F.lit(0.9)
    km = sphere_distance(lon, lat, F.lit(0.0), F.lit(0.0)) / F.lit(1000.0)
    return inc.select("incident_id", F.round(km, 3).alias("distance_km"))


def q_points_in_blocks(spark, d):
    pts = cm.incidents(spark, d).select("incident_id", "lon", "lat")
    blocks = cm.census_blocks(spark, d).select("block_id", "COMM", "geometry")
    return spatial_join(pts, blocks, "lon", "lat", cell_size=CELL).select("incident_id", "block_id", "COMM")


def q_points_in_blocks_left(spark, d):
    pts = cm.incidents(spark, d).select("incident_id", "lon", "lat")
    blocks = cm.census_blocks(spark, d).filter(F.col("CITY") == CITY).select("block_id", "geometry")
    return spatial_join(pts, blocks, "lon", "lat", how="left", cell_size=CELL).select("incident_id", "block_id")


def q_dissolve_communities(spark, d):
    blocks = cm.census_blocks(spark, d)
    out = dissolve(blocks, "COMM", aggs=[F.sum("POP_2010").alias("population")])
    perim = F.aggregate("edges", F.lit(0.0), lambda a, e: a + planar_distance(e.x1, e.y1, e.x2, e.y2))
    return out.select("COMM", "population", F.size("edges").alias("n_edges"), perim.alias("perimeter"),
                      "x_min", "x_max", "y_min", "y_max")


def q_dissolved_community_count(spark, d):
    # the city's blocks dissolved per community, then a whole-table count
    blocks = cm.census_blocks(spark, d).filter(F.col("CITY") == CITY)
    comms = dissolve(blocks, "COMM", aggs=[F.sum("POP_2010").alias("population")])
    return comms.agg(F.count(F.lit(1)).alias("n_communities"), F.sum("population").alias("population"))


def q_dissolve_within(spark, d):
    blocks = cm.census_blocks(spark, d)
    comms = dissolve(blocks, "COMM")
    pts = cm.incidents(spark, d).select("lon", "lat")
    hits = spatial_join(pts, comms, "lon", "lat", cell_size=2 * CELL)
    return hits.groupBy("COMM").agg(F.count(F.lit(1)).alias("crime_count"))


def _q3(spark, d, strategy=None, spatial=None, blocks=None, income=None):
    return reports.income_crime_report(blocks or cm.census_blocks(spark, d), income or cm.income(spark, d),
                                       cm.incidents(spark, d), CITY, x="lon", y="lat", income_strategy=strategy,
                                       spatial_strategy=spatial or strategy, cell_size=2 * CELL)


def q_income_duplicate_zip(spark, d):
    # the income table holds every third zip twice: its income and people count twice, its incidents once
    income = cm.income(spark, d)
    return _q3(spark, d, income=income.unionByName(income.where(F.col("Zip Code") % 3 == 0)))


def q_null_community(spark, d):
    # blocks without a community are one community of their own
    blocks = cm.census_blocks(spark, d)
    named = F.floor(F.col("block_id") / 8) % 10 != 1
    return _q3(spark, d, blocks=blocks.withColumn("COMM", F.when(named, F.col("COMM"))))


def _q3_pair(first, second):
    return lambda spark, d: _q3(spark, d, first, second)


def q_income_crime_per_capita(spark, d):
    return _q3(spark, d)


def q_income_crime_per_capita_broadcast(spark, d):
    return _q3(spark, d, "BROADCAST")


def q_income_crime_per_capita_merge(spark, d):
    return _q3(spark, d, "MERGE")


def q_income_crime_per_capita_shuffle_hash(spark, d):
    return _q3(spark, d, "SHUFFLE_HASH")


def q_top_bottom_profile(spark, d):
    return reports.descent_profile_one_pass(cm.census_blocks(spark, d), cm.income(spark, d), cm.incidents(spark, d),
                                            cm.priority_codes(spark), CITY, 3, x="lon", y="lat", code_col="code",
                                            codes_key="code", label_col="label", cell_size=CELL) \
        .withColumnRenamed("count", "crime_count")


def q_top_bottom_profile_two_pass(spark, d):
    ranking = _q3(spark, d)
    return reports.descent_profile_report(ranking, cm.incidents(spark, d), cm.census_blocks(spark, d),
                                          cm.priority_codes(spark), 3, x="lon", y="lat", code_col="code",
                                          codes_key="code", label_col="label", cell_size=CELL) \
        .withColumnRenamed("count", "crime_count")


def q_top_bottom_incidents(spark, d):
    ranking = _q3(spark, d)
    return reports.descent_profile_rows(ranking, cm.incidents(spark, d), cm.census_blocks(spark, d),
                                        cm.priority_codes(spark), 3, x="lon", y="lat", code_col="code",
                                        codes_key="code", label_col="label", keep=("incident_id",),
                                        cell_size=CELL) \
        .select("incident_id", "side", "COMM", F.col("label").alias("descent"))


def q_nearest_station(spark, d):
    return reports.nearest_station_report(cm.incidents(spark, d), cm.stations(spark, d), key="incident_id",
                                          x="lon", y="lat", station_x="sx", station_y="sy", division="division") \
        .select("division", "crime_count", F.round("average_distance", 9).alias("average_distance"))


def q_nearest_ties(spark, d):
    # the stations share 21 spots; an incident keeps every station of its nearest spot
    spot = F.col("station_id") % 21
    st = cm.stations(spark, d).select("division", cm.hashed_coordinate(spot, cm.STATION_MULT_X, cm.STATION_OFF_X).alias("sx"),
                                      cm.hashed_coordinate(spot, cm.STATION_MULT_Y, cm.STATION_OFF_Y).alias("sy"))
    return reports.nearest_station_report(cm.incidents(spark, d), st, key="incident_id", x="lon", y="lat", station_x="sx",
                                          station_y="sy", division="division") \
        .select("division", "crime_count", F.round("average_distance", 9).alias("average_distance"))


def q_nearest_station_knn(spark, d):
    return reports.knn_station_report(cm.incidents(spark, d), cm.stations(spark, d), key="incident_id", x="lon",
                                      y="lat", station_x="sx", station_y="sy", station_key="station_id",
                                      division="division") \
        .select("division", "crime_count", F.round("average_distance", 9).alias("average_distance"))


def q_nearest_k(spark, d):
    st = cm.stations(spark, d).select("station_id", "sx", "sy")
    out = reports.k_nearest_stations(cm.incidents(spark, d), st, 3, key="incident_id", x="lon", y="lat",
                                     station_x="sx", station_y="sy", station_key="station_id")
    return out.select("incident_id", "neighbor_rank", "station_id", F.round("distance", 9).alias("distance"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "age_bucket_count": q_age_bucket_count,
    "age_bucket_count_lineitem": q_age_bucket_count_lineitem,
    "closed_rate_rank": q_closed_rate_rank,
    "closed_rate_rank_sql": q_closed_rate_rank_sql,
    "closed_rate_rank_rowwise": q_closed_rate_rank_rowwise,
    "closed_rate_rank_parquet": q_closed_rate_rank_parquet,
    "closed_rate_rank_csv": q_closed_rate_rank_csv,
    "currency_clean": q_currency_clean,
    "ts_parse": q_ts_parse,
    "geojson_features": q_geojson_features,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_no_header_schema": q_csv_no_header_schema,
    "word_count": q_word_count,
    "text_file_word_count": q_text_file_word_count,
    "bottom_k": q_bottom_k,
    "top_k_in_group": q_top_k_in_group,
    "top_k_in_group_sql": q_top_k_in_group_sql,
    "yearly_income": q_yearly_income,
    "yearly_income_udf": q_yearly_income_udf,
    "code_lookup": q_code_lookup,
    "point_distance": q_point_distance,
    "haversine": q_haversine,
    "points_in_blocks": q_points_in_blocks,
    "points_in_blocks_left": q_points_in_blocks_left,
    "dissolve_communities": q_dissolve_communities,
    "dissolve_within": q_dissolve_within,
    "dissolved_community_count": q_dissolved_community_count,
    "income_crime_per_capita": q_income_crime_per_capita,
    "income_crime_per_capita_geojson": q_income_crime_per_capita_geojson,
    "income_crime_per_capita_broadcast": q_income_crime_per_capita_broadcast,
    "income_crime_per_capita_merge": q_income_crime_per_capita_merge,
    "income_crime_per_capita_shuffle_hash": q_income_crime_per_capita_shuffle_hash,
    "top_bottom_profile": q_top_bottom_profile,
    "top_bottom_profile_two_pass": q_top_bottom_profile_two_pass,
    "top_bottom_incidents": q_top_bottom_incidents,
    "nearest_station": q_nearest_station,
    "nearest_station_knn": q_nearest_station_knn,
    "nearest_k": q_nearest_k,
    "nearest_ties": q_nearest_ties,
    "null_status_rate": q_null_status_rate,
    "null_status_rate_rowwise": q_null_status_rate_rowwise,
    "dirty_text_clean": q_dirty_text_clean,
    "missing_coordinates": q_missing_coordinates,
    "code_table_csv": q_code_table_csv,
    "geojson_discovered": q_geojson_discovered,
    "income_duplicate_zip": q_income_duplicate_zip,
    "null_community": q_null_community,
}

# the pairs of different hints for Q3's two joins; the equal ones are registered above
HINT_PAIRS = [(a, b) for a in SUPPORTED_STRATEGIES for b in SUPPORTED_STRATEGIES if a != b]
QUERIES |= {f"income_crime_per_capita_{a}_then_{b}".lower(): _q3_pair(a, b) for a, b in HINT_PAIRS}
QUERIES |= GEO_QUERIES
