"""DuckDB SQL for every registered query (the correctness oracle).

The SQL repeats the city model's integer arithmetic (see ``city_model``) and finds
the square / triangle holding each point in closed form, so it is an independent
computation of the answers the Spark operators produce with grid joins, ray casts,
dissolves and nearest-site rounds.  Sums are cast to BIGINT and years to INTEGER so
the column types line up with Spark's.
"""

from __future__ import annotations

from ..operators.strategy import SUPPORTED_STRATEGIES
from .city_model import PRIORITY_LABELS

_PTS = """pts AS (
    SELECT o_orderkey AS incident_id, o_orderpriority AS code,
           CAST((o_orderkey * 7919) % 1000000 AS DOUBLE) / CAST(10000 AS DOUBLE) + CAST(0.00005 AS DOUBLE) AS x,
           CAST((o_orderkey * 104729) % 1000000 AS DOUBLE) / CAST(10000 AS DOUBLE) + CAST(0.000025 AS DOUBLE) AS y
    FROM orders)"""

_LOC = """loc AS (
    SELECT pts.*,
           CAST(floor(y / 20) AS BIGINT) * 5 + CAST(floor(x / 20) AS BIGINT) AS n,
           (CAST(floor(x / 10) AS BIGINT) % 2) + 2 * (CAST(floor(y / 10) AS BIGINT) % 2) AS q,
           CASE WHEN (y - floor(y / 10) * 10) < (x - floor(x / 10) * 10) THEN 0 ELSE 1 END AS t
    FROM pts)"""

_BLOCKS = """blk AS (
    SELECT n.n_nationkey AS n, n.n_name AS comm, r.r_name AS city, g.k AS k,
           CAST(n.n_nationkey * 8 + g.k AS BIGINT) AS block_id,
           CAST(90000 + n.n_nationkey * 4 + g.k // 2 AS VARCHAR) AS zcta
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    CROSS JOIN (SELECT CAST(range AS INTEGER) AS k FROM range(0, 8)) g),
ppl AS (
    SELECT c_nationkey AS n, CAST(c_custkey % 8 AS INTEGER) AS k, COUNT(*) AS pop,
           COUNT(*) FILTER (WHERE c_acctbal > 0) AS housing
    FROM customer GROUP BY 1, 2),
blocks AS (
    SELECT blk.*, COALESCE(ppl.pop, 0) AS pop, COALESCE(ppl.housing, 0) AS housing
    FROM blk LEFT JOIN ppl ON blk.n = ppl.n AND blk.k = ppl.k)"""

_INCOME = """inc AS (
    SELECT CAST(90000 + c_nationkey * 4 + (c_custkey % 8) // 2 AS INTEGER) AS zip,
           CAST(SUM(CAST(round(abs(c_acctbal) * 100) AS BIGINT)) // (COUNT(*) * 10) AS BIGINT) AS median
    FROM customer GROUP BY 1)"""

_CODES = "codes AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{lbl}')" for c, lbl in PRIORITY_LABELS) + ") t(code, label))"

_STATIONS = """st AS (
    SELECT s_suppkey AS station_id, s_name AS division,
           CAST((s_suppkey * 15485863) % 1000000 AS DOUBLE) / CAST(10000 AS DOUBLE) + CAST(0.00003 AS DOUBLE) AS sx,
           CAST((s_suppkey * 32452843) % 1000000 AS DOUBLE) / CAST(10000 AS DOUBLE) + CAST(0.00001 AS DOUBLE) AS sy
    FROM supplier)"""


def _q3_ctes(city: str, blocks: str = _BLOCKS, repeated: str = "false") -> str:
    return f"""WITH {_PTS}, {_LOC}, {blocks}, {_INCOME},
income AS (SELECT * FROM inc UNION ALL SELECT * FROM inc WHERE {repeated}),
zips AS (SELECT zcta, comm, SUM(housing) AS housing, SUM(pop) AS population
         FROM blocks WHERE city = '{city}' GROUP BY zcta, comm),
jz AS (SELECT zips.*, income.median FROM zips JOIN income ON TRY_CAST(zcta AS INTEGER) = income.zip),
ci AS (SELECT comm, CAST(SUM(population) AS BIGINT) AS comm_population,
              CAST(SUM(housing * median) AS BIGINT) AS comm_income FROM jz GROUP BY comm),
area AS (SELECT DISTINCT zcta, comm FROM jz),
cr AS (SELECT area.comm, COUNT(*) AS crimes FROM loc
       JOIN area ON CAST(90000 + loc.n * 4 + loc.q AS VARCHAR) = area.zcta GROUP BY area.comm),
q3 AS (SELECT ci.comm AS COMM,
              CASE WHEN comm_population = 0 THEN NULL ELSE CAST(crimes AS DOUBLE) / CAST(comm_population AS DOUBLE) END
                  AS crimes_per_capita,
              CASE WHEN comm_population = 0 THEN NULL ELSE CAST(comm_income AS DOUBLE) / CAST(comm_population AS DOUBLE) END
                  AS income_per_capita
       FROM ci JOIN cr ON ci.comm IS NOT DISTINCT FROM cr.comm)"""


def _age_sql(table: str, value: str, text: str, needle: str) -> str:
    return f"""SELECT CASE WHEN {value} < 18 THEN '<18'
                WHEN {value} >= 18 AND {value} <= 24 THEN '18-24'
                WHEN {value} >= 25 AND {value} <= 64 THEN '25-64'
                WHEN {value} > 64 THEN '>64' END AS age_group,
           COUNT(*) AS crime_count
    FROM {table} WHERE contains({text}, '{needle}') GROUP BY 1"""


def _closed_sql(status: str = "o.o_orderstatus", closed: str = "status NOT IN ('O', 'P')") -> str:
    return f"""WITH inc AS (
    SELECT o.o_orderdate AS occurred, n.n_name AS area_name, {status} AS status
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
r AS (SELECT CAST(year(occurred) AS INTEGER) AS year, area_name AS precinct,
             CAST(COUNT(*) FILTER ({closed}) AS DOUBLE) / COUNT(*) AS closed_case_rate
      FROM inc GROUP BY 1, 2)
SELECT year, precinct, closed_case_rate,
       RANK() OVER (PARTITION BY year ORDER BY closed_case_rate DESC) AS case_rank
FROM r"""


_CLOSED = _closed_sql()
_NO_STATUS = "CASE WHEN day(o.o_orderdate) % 3 <> 0 THEN o.o_orderstatus END"
_ROWWISE = "status IS NULL OR status NOT IN ('O', 'P')"

_WORDS = """SELECT word, COUNT(*) AS word_count
FROM (SELECT unnest(regexp_split_to_array(text, '[\\n ]')) AS word FROM documents)
GROUP BY word"""

_Q3 = _q3_ctes("AMERICA") + "\nSELECT * FROM q3"

ORACLE_SQL: dict[str, str] = {
    "age_bucket_count": _age_sql("part", "p_size", "p_type", "A"),
    "age_bucket_count_lineitem": _age_sql("lineitem", "l_quantity", "l_returnflag", "R"),
    "closed_rate_rank": _CLOSED,
    "closed_rate_rank_sql": _CLOSED,
    "closed_rate_rank_parquet": _CLOSED,
    "currency_clean": """SELECT o_orderkey, '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS price_text,
       CAST(floor(o_totalprice) AS BIGINT) AS price_int FROM orders""",
    "ts_parse": """SELECT o_orderkey, o_orderdate AS occurred, CAST(year(o_orderdate) AS INTEGER) AS occurred_year,
       o_orderstatus AS area FROM orders""",
    "geojson_features": f"""WITH {_BLOCKS}
SELECT block_id, comm AS COMM, city AS CITY, zcta AS ZCTA10, CAST(pop AS BIGINT) AS POP_2010,
       CASE WHEN block_id % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END AS geometry_type,
       4 AS n_vertices, CAST(50.0 AS DOUBLE) AS area,
       CAST((n % 5) * 20 + ((k // 2) % 2) * 10 AS DOUBLE) AS x_min,
       CAST((n // 5) * 20 + ((k // 2) // 2) * 10 AS DOUBLE) AS y_min
FROM blocks""",
    "csv_roundtrip": """SELECT s_suppkey, s_name, s_acctbal, s_name || ', ' || n_name AS location
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "csv_no_header_schema": """SELECT c_custkey AS id, c_name AS name, c_acctbal AS salary, c_nationkey AS dep_id
FROM customer""",
    "word_count": _WORDS,
    "text_file_word_count": _WORDS,
    "bottom_k": "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS salary FROM supplier ORDER BY salary, id LIMIT 5",
    "top_k_in_group": """SELECT c_custkey AS id, c_name AS name, c_acctbal AS salary
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_1'
ORDER BY salary DESC, id LIMIT 3""",
    "yearly_income": """SELECT c_name AS name, 14 * c_acctbal + CAST(c_nationkey AS DOUBLE) * CAST(100 AS DOUBLE) AS yearly
FROM customer""",
    "code_lookup": f"""WITH {_CODES}
SELECT codes.label AS priority_label, COUNT(*) AS crime_count
FROM orders LEFT JOIN codes ON o_orderpriority = codes.code GROUP BY 1""",
    "point_distance": f"""WITH {_PTS}
SELECT incident_id, round(sqrt((CAST(50 AS DOUBLE) - x) * (CAST(50 AS DOUBLE) - x)
                             + (CAST(50 AS DOUBLE) - y) * (CAST(50 AS DOUBLE) - y)), 9) AS distance FROM pts""",
    "haversine": f"""WITH {_PTS},
g AS (SELECT incident_id, x - 50 AS lon, (y - 50) * CAST(0.9 AS DOUBLE) AS lat FROM pts),
h AS (SELECT incident_id,
             sin(radians(0 - lat) / 2) * sin(radians(0 - lat) / 2)
             + cos(radians(lat)) * cos(radians(0.0)) * sin(radians(0 - lon) / 2) * sin(radians(0 - lon) / 2) AS h
      FROM g)
SELECT incident_id, round(2 * 6371008.0 * asin(sqrt(least(h, 1.0))) / 1000.0, 3) AS distance_km FROM h""",
    "points_in_blocks": f"""WITH {_PTS}, {_LOC}
SELECT incident_id, n * 8 + q * 2 + t AS block_id, nation.n_name AS COMM
FROM loc JOIN nation ON loc.n = nation.n_nationkey""",
    "points_in_blocks_left": f"""WITH {_PTS}, {_LOC}
SELECT incident_id, CASE WHEN r.r_name = 'AMERICA' THEN n * 8 + q * 2 + t END AS block_id
FROM loc JOIN nation ON loc.n = nation.n_nationkey JOIN region r ON nation.n_regionkey = r.r_regionkey""",
    "dissolve_communities": f"""WITH {_BLOCKS}
SELECT comm AS COMM, CAST(SUM(pop) AS BIGINT) AS population, 8 AS n_edges, CAST(80.0 AS DOUBLE) AS perimeter,
       CAST(MIN((n % 5) * 20) AS DOUBLE) AS x_min, CAST(MIN((n % 5) * 20) + 20 AS DOUBLE) AS x_max,
       CAST(MIN((n // 5) * 20) AS DOUBLE) AS y_min, CAST(MIN((n // 5) * 20) + 20 AS DOUBLE) AS y_max
FROM blocks GROUP BY comm""",
    "dissolve_within": f"""WITH {_PTS}, {_LOC}
SELECT nation.n_name AS COMM, COUNT(*) AS crime_count FROM loc JOIN nation ON loc.n = nation.n_nationkey GROUP BY 1""",
    "income_crime_per_capita": _Q3,
    "income_crime_per_capita_broadcast": _Q3,
    "income_crime_per_capita_merge": _Q3,
    "income_crime_per_capita_shuffle_hash": _Q3,
    "top_bottom_profile": _q3_ctes("AMERICA") + f""",
{_CODES},
top AS (SELECT COMM, 'top' AS side FROM q3 ORDER BY income_per_capita DESC NULLS LAST, COMM LIMIT 3),
bottom AS (SELECT COMM, 'bottom' AS side FROM q3 ORDER BY income_per_capita ASC NULLS FIRST, COMM LIMIT 3),
chosen AS (SELECT * FROM top UNION ALL SELECT * FROM bottom)
SELECT chosen.side, codes.label AS descent, COUNT(*) AS crime_count
FROM loc JOIN nation nn ON loc.n = nn.n_nationkey JOIN chosen ON chosen.COMM = nn.n_name
LEFT JOIN codes ON loc.code = codes.code
GROUP BY 1, 2""",
    "nearest_station": f"""WITH {_PTS}, {_STATIONS},
d AS (SELECT incident_id, division, sqrt((sx - x) * (sx - x) + (sy - y) * (sy - y)) AS distance FROM pts CROSS JOIN st),
m AS (SELECT incident_id, MIN(distance) AS md FROM d GROUP BY 1)
SELECT division, COUNT(*) AS crime_count, round(AVG(distance), 9) AS average_distance
FROM d JOIN m ON d.incident_id = m.incident_id AND d.distance = m.md GROUP BY division""",
    "nearest_k": f"""WITH {_PTS}, {_STATIONS},
d AS (SELECT incident_id, station_id, sqrt((sx - x) * (sx - x) + (sy - y) * (sy - y)) AS distance
      FROM pts CROSS JOIN st),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY incident_id ORDER BY distance, station_id) AS rn FROM d)
SELECT incident_id, CAST(rn AS INTEGER) AS neighbor_rank, station_id, round(distance, 9) AS distance
FROM r WHERE rn <= 3""",
}
ORACLE_SQL["top_k_in_group_sql"] = ORACLE_SQL["top_k_in_group"]
ORACLE_SQL["closed_rate_rank_csv"] = _CLOSED
ORACLE_SQL["dissolved_community_count"] = f"""WITH {_BLOCKS}
SELECT COUNT(DISTINCT comm) AS n_communities, CAST(SUM(pop) AS BIGINT) AS population
FROM blocks WHERE city = 'AMERICA'"""
ORACLE_SQL["top_bottom_profile_two_pass"] = ORACLE_SQL["top_bottom_profile"]
ORACLE_SQL["income_crime_per_capita_geojson"] = _Q3
ORACLE_SQL["closed_rate_rank_rowwise"] = _closed_sql(closed=_ROWWISE)
ORACLE_SQL["top_bottom_incidents"] = _q3_ctes("AMERICA") + f""",
{_CODES},
top AS (SELECT COMM, 'top' AS side FROM q3 ORDER BY income_per_capita DESC NULLS LAST, COMM LIMIT 3),
bottom AS (SELECT COMM, 'bottom' AS side FROM q3 ORDER BY income_per_capita ASC NULLS FIRST, COMM LIMIT 3),
chosen AS (SELECT * FROM top UNION ALL SELECT * FROM bottom)
SELECT loc.incident_id, chosen.side, chosen.COMM, codes.label AS descent
FROM loc JOIN nation nn ON loc.n = nn.n_nationkey JOIN chosen ON chosen.COMM = nn.n_name
LEFT JOIN codes ON loc.code = codes.code"""
ORACLE_SQL["nearest_station_knn"] = f"""WITH {_PTS}, {_STATIONS},
d AS (SELECT incident_id, station_id, division, sqrt((sx - x) * (sx - x) + (sy - y) * (sy - y)) AS distance
      FROM pts CROSS JOIN st),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY incident_id ORDER BY distance, station_id) AS rn FROM d)
SELECT division, COUNT(*) AS crime_count, round(AVG(distance), 9) AS average_distance
FROM r WHERE rn = 1 GROUP BY division"""
ORACLE_SQL["yearly_income_udf"] = ORACLE_SQL["yearly_income"]
ORACLE_SQL["null_status_rate"] = _closed_sql(_NO_STATUS)
ORACLE_SQL["null_status_rate_rowwise"] = _closed_sql(_NO_STATUS, _ROWWISE)
ORACLE_SQL["dirty_text_clean"] = """SELECT o_orderkey,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(floor(o_totalprice) AS INTEGER) END AS price,
       CASE WHEN o_orderkey % 3 = 1 THEN o_orderdate END AS occurred,
       CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey AS DOUBLE) END AS per_person
FROM orders"""
ORACLE_SQL["missing_coordinates"] = f"""WITH {_PTS}
SELECT incident_id, x AS LON, y AS LAT FROM pts WHERE incident_id % 5 <> 0 AND incident_id % 11 <> 0"""
ORACLE_SQL["code_table_csv"] = """SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'Label, ' || lower(o_orderpriority) END AS priority_label,
       COUNT(*) AS crime_count FROM orders GROUP BY 1"""
ORACLE_SQL["geojson_discovered"] = f"""WITH {_BLOCKS}
SELECT block_id, comm AS COMM, city AS CITY, zcta AS ZCTA10, CAST(housing AS BIGINT) AS HOUSING10, CAST(pop AS BIGINT) AS POP_2010,
       CASE WHEN block_id % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END AS geometry_type
FROM blocks"""
ORACLE_SQL["income_duplicate_zip"] = _q3_ctes("AMERICA", repeated="zip % 3 = 0") + "\nSELECT * FROM q3"
ORACLE_SQL["null_community"] = _q3_ctes("AMERICA", _BLOCKS.replace(
    "n.n_name AS comm", "CASE WHEN n.n_nationkey % 10 <> 1 THEN n.n_name END AS comm")) + "\nSELECT * FROM q3"
ORACLE_SQL["nearest_ties"] = ORACLE_SQL["nearest_station"].replace("(s_suppkey *", "((s_suppkey % 21) *")
ORACLE_SQL |= {f"income_crime_per_capita_{a}_then_{b}".lower(): _Q3
               for a in SUPPORTED_STRATEGIES for b in SUPPORTED_STRATEGIES if a != b}
