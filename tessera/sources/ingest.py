"""Readers, writers and clean-up jobs for the incident, census, income and code files.

All readers are plain ``DataFrameReader`` calls so Catalyst keeps pruning columns and
pushing filters into the scan; known datasets get declared schemas instead of an
inference pass over the files.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.cleaning import INCIDENT_TS_FORMAT, parse_currency, parse_timestamp
from ..functions.geometry import MULTIPOLYGON_TYPE
from ..session import scratch_path


# The headers of the known files, with their types as text in the file allows.
INCIDENTS = """DR_NO long, `Date Rptd` string, `DATE OCC` string, `TIME OCC` int, `AREA ` int, `AREA NAME` string,
    `Rpt Dist No` int, `Part 1-2` int, `Crm Cd` int, `Crm Cd Desc` string, Mocodes string, `Vict Age` int, `Vict Sex` string,
    `Vict Descent` string, `Premis Cd` int, `Premis Desc` string, `Weapon Used Cd` int, `Weapon Desc` string, Status string,
    `Status Desc` string, `Crm Cd 1` int, `Crm Cd 2` int, `Crm Cd 3` int, `Crm Cd 4` int, LOCATION string,
    `Cross Street` string, LAT double, LON double"""
STATIONS = "X double, Y double, FID int, DIVISION string, LOCATION string, PREC int"
INCOME = "`Zip Code` int, Community string, `Estimated Median Income` string"
DESCENT_CODES = "`Vict Descent` string, `Vict Descent Full` string"


# --- sources -----------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """CSV file or directory.  With no schema the types are inferred (one extra pass).

    Quoted fields holding commas and a leading UTF-8 byte-order mark are handled by
    Spark's CSV reader.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.options(**options).csv(path)


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    """The incident file, by its declared schema, with timestamps parsed and column names repaired."""
    return clean_incidents(read_csv(spark, path, INCIDENTS))


def read_income(spark: SparkSession, path: str) -> DataFrame:
    return clean_income(read_csv(spark, path, INCOME))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STATIONS)


def read_descent_codes(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, DESCENT_CODES)


def read_csv_no_header(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header-less CSV with fields cast by position to ``schema``."""
    return spark.read.schema(schema).csv(path, header=False)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def geojson_properties(spark: SparkSession, path: str, multi_line: bool = True) -> StructType:
    """The properties (names, types) that the features of the files hold, found by one more pass over them."""
    found = spark.read.option("multiLine", multi_line).json(path).schema
    fields: dict[str, StructField] = {}
    inner = found["features"].dataType.elementType if "features" in found.names else StructType()
    for level in (inner, found):
        if "properties" in level.names:
            fields = {f.name: f for f in level["properties"].dataType} | fields
    return StructType(list(fields.values()))


def read_geojson(spark: SparkSession, path: str, properties: StructType | None = None, multi_line: bool = True) -> DataFrame:
    """GeoJSON FeatureCollection(s) -> one row per feature: properties promoted to
    columns plus ``geometry`` as MultiPolygon coordinates and ``geometry_type``.

    ``multi_line=True`` reads one whole document per file (the usual layout);
    ``multi_line=False`` reads one FeatureCollection or one bare Feature per line (a
    GeoJSON text sequence), which splits across tasks and is the layout to use at scale.

    Without declared ``properties`` their names and types are discovered (:func:`geojson_properties`).

    Coordinates are read as raw JSON text and parsed by geometry type, because schema
    inference over a mix of Polygon and MultiPolygon degrades both to strings.
    """
    if properties is None:
        properties = geojson_properties(spark, path, multi_line)
    feature = StructType([
        StructField("type", StringType()),
        StructField("properties", properties),
        StructField("geometry", StructType([
            StructField("type", StringType()),
            StructField("coordinates", StringType()),
        ])),
    ])
    # A document is a FeatureCollection or a bare Feature (one per line in a GeoJSON
    # text sequence); both shapes are read with one schema.
    doc = StructType([StructField("type", StringType()), StructField("features", ArrayType(feature)),
                      StructField("properties", properties), feature["geometry"]])
    raw = spark.read.schema(doc).option("multiLine", multi_line).json(path)
    bare = F.array(F.struct(F.col("type"), F.col("properties"), F.col("geometry")))
    feats = raw.select(F.explode(F.when(F.col("type") == "Feature", bare).otherwise(F.col("features"))).alias("f"))
    return flatten_features(feats.select("f.*"))


def read_geojson_document(spark: SparkSession, path: str, properties: StructType | None = None, split_bytes: int | None = None) -> DataFrame:
    """One large FeatureCollection (or several), however it is laid out, read by many tasks: as :func:`read_geojson`.

    The files are scanned in byte ranges with ``}`` as the end of a record.  A first pass gives each range's change of
    brace depth and of the state inside or outside a string, for either state at its start; the ranges' states follow one from
    the other.  The second pass cuts features where the depth says so and puts together those that lie in several
    ranges.  They are written one a line, and read as a text sequence.  ``split_bytes`` is the size of a range (default: Spark's).
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        if split_bytes:
            spark.conf.set(name, str(split_bytes))
        features = document_features(spark, path)
        target = scratch_path(spark, "geojson-features")
        features.write.text(target)
    finally:
        spark.conf.set(name, before)
    return read_geojson(spark, target, properties, multi_line=False)


RANGE = ["file", "start"]


def _outside(record: str, inside: bool) -> list[str]:
    """The parts of a record that lie outside strings, and (last) whether it ends inside one."""
    parts = _parts(record)
    return parts[1 if inside else 0::2], inside != (len(parts) % 2 == 0)


def _parts(record: str) -> list[str]:
    """``record`` cut at its quotes; escaped quotes and backslashes, which don't count, are left out."""
    return (record.replace("\\\\", "").replace('\\"', "") if "\\" in record else record).split('"')


def document_features(spark: SparkSession, path: str) -> DataFrame:
    """value: the features of GeoJSON documents, one a row, whatever their layout (see :func:`read_geojson_document`)."""
    scan = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def measure(batches):
        """For each range and state at its start: the state at its end, its change of depth, and the lowest change on the way."""
        now: dict[tuple, list] = {}
        for b in batches:
            for value, file, start in zip(*(b.column(c).to_pylist() for c in ("value", *RANGE))):
                states = now.setdefault((file, start), [[False, 0, 0], [True, 0, 0]])
                parts = _parts(value + "}")  # once for either state
                change = [p.count("{") - p.count("}") for p in ("".join(parts[0::2]), "".join(parts[1::2]))]
                for s in states:
                    s[1] += change[s[0]]
                    s[0] ^= len(parts) % 2 == 0
                    s[2] = min(s[2], s[1])  # a record ends at its closing brace
        rows = [(f, st, int(k), bool(s[0]), s[1], s[2]) for (f, st), states in now.items() for k, s in enumerate(states)]
        columns = list(zip(*rows)) or [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*RANGE, "inside", "after", "change", "lowest"])

    measured = scan.mapInArrow(measure, "file string, start long, inside int, after boolean, change long, lowest long")
    starts: dict[tuple, tuple] = {}
    ranges: dict[tuple, dict] = {}
    # two rows a range; sorted here, as a distributed sort would read the files once more to find its limits
    for r in sorted(measured.collect(), key=lambda r: (r["file"], r["start"])):
        ranges.setdefault((r["file"], r["start"]), {})[r["inside"]] = r
    file = None
    for (f, start), own in ranges.items():
        if f != file:
            file, inside, depth, owner = f, False, 0, None
        starts[f, start] = inside, depth, owner
        r = own[int(inside)]
        if depth + r["lowest"] <= 1:
            owner = start  # what is open at the end was opened here
        inside, depth = r["after"], depth + r["change"]
    shared = spark.sparkContext.broadcast(starts)

    def cut(batches):
        """file, owner, start, text: whole features (no owner), and parts of those that began in range ``owner``."""
        at, inside, depth, owner, parts = None, False, 0, None, []
        for b in batches:
            out: list[tuple] = []
            for value, *place in zip(*(b.column(c).to_pylist() for c in ("value", *RANGE))):
                if place != at:
                    if parts:
                        out.append((at[0], at[1] if owner is None else owner, at[1], "".join(parts)))
                    at, parts = place, []
                    inside, depth, owner = shared.value[tuple(place)]
                    owner = owner if depth >= 2 else None
                record = value + "}"
                if depth < 2:
                    first = None
                    for m in re.finditer(r'\\.|["{}]', record, re.S):
                        if m.group() == '"':
                            inside = not inside
                        elif not inside and m.group() in "{}":
                            depth += 1 if m.group() == "{" else -1
                            first = m.start() if depth == 2 and m.group() == "{" else first
                    parts = [] if first is None else [record[first:]]
                else:
                    outside, inside = _outside(record, inside)
                    depth += sum(p.count("{") - p.count("}") for p in outside)
                    parts.append(record)
                if parts and depth < 2:
                    out.append((place[0], owner, place[1], "".join(parts)))
                    owner, parts = None, []
            if out:
                yield _parts_batch(out)
        if parts:
            yield _parts_batch([(at[0], at[1] if owner is None else owner, at[1], "".join(parts))])

    pieces = scan.mapInArrow(cut, "file string, owner long, start long, text string").checkpoint(eager=True)
    whole = pieces.where("owner is null").select("text")
    joined = (pieces.where("owner is not null").groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("p"))
              .select(F.array_join(F.col("p.text"), "").alias("text")))
    return whole.unionByName(joined).select(F.regexp_replace("text", r"[\r\n]+", " ").alias("value"))


def _parts_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "owner", "start", "text"])


def flatten_features(features: DataFrame) -> DataFrame:
    """``type, properties, geometry`` rows -> property columns + parsed geometry."""
    gtype = F.col("geometry.type")
    coords = F.col("geometry.coordinates")
    geom = (
        F.when(gtype == "Polygon", F.array(F.from_json(coords, MULTIPOLYGON_TYPE.elementType)))
        .when(gtype == "MultiPolygon", F.from_json(coords, MULTIPOLYGON_TYPE))
    )
    return features.select(
        "properties.*",
        gtype.alias("geometry_type"),
        geom.alias("geometry"),
    )


# --- clean-up jobs -------------------------------------------------------------------

def clean_incidents(df: DataFrame, ts_columns=("Date Rptd", "DATE OCC"), fmt: str = INCIDENT_TS_FORMAT,
                    renames: dict[str, str] | None = None) -> DataFrame:
    """Parse the 12-hour timestamp columns and repair column names (``"AREA "`` ->
    ``"AREA"``).  Missing columns are skipped; a second run is a no-op."""
    renames = {"AREA ": "AREA"} if renames is None else renames
    present = set(df.columns)
    typed = {c: parse_timestamp(F.col(f"`{c}`"), fmt) for c in ts_columns
             if c in present and isinstance(df.schema[c].dataType, StringType)}
    if typed:
        df = df.withColumns(typed)
    for old, new in renames.items():
        df = df.withColumnRenamed(old, new)
    return df


def clean_income(df: DataFrame, column: str = "Estimated Median Income") -> DataFrame:
    """Currency text -> int in place."""
    return df.withColumn(column, parse_currency(F.col(f"`{column}`")))


def drop_missing_coordinates(df: DataFrame, x: str = "LON", y: str = "LAT") -> DataFrame:
    """Keep rows with both coordinates; (0, 0) is kept, only NULLs go."""
    return df.filter(F.col(f"`{x}`").isNotNull() & F.col(f"`{y}`").isNotNull())


# --- sinks -------------------------------------------------------------------------

def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                  max_records_per_file: int | None = None) -> str:
    """Parquet sink.  Files stay one per task: funnelling a large table through a single
    writer task (a one-file output) is deliberately not offered."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return path


def write_geojson(df: DataFrame, path: str, geometry: str = "geometry", mode: str = "overwrite") -> str:
    """GeoJSON sink: one Feature a line (a text sequence any number of tasks can read again), every other column a property.

    Polygon if the geometry has one part, else MultiPolygon; a NULL geometry stays NULL.
    """
    properties = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != geometry]), {"ignoreNullFields": "false"})
    g = F.col(geometry)
    shape = F.when(F.size(g) == 1, F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(g[0]), F.lit("}"))).when(
        g.isNotNull(), F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(g), F.lit("}"))).otherwise(F.lit("null"))
    line = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), shape, F.lit("}"))
    df.select(line.alias("value")).write.mode(mode).text(path)
    return path


def write_document(features: DataFrame, path: str, column: str) -> str:
    """One FeatureCollection a task, on one line, of the feature texts in ``column``; what many tools write as one file."""
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array(['{"type": "FeatureCollection", "crs": {"name": "x"}, "features": ['])], ["value"])
        first = True
        for b in batches:
            texts = b.column(0).to_pylist()
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array([("" if first else ", ") + ", ".join(texts)])], ["value"])
                first = False
        yield pa.RecordBatch.from_arrays([pa.array(["]}"])], ["value"])

    features.select(column).mapInArrow(run, "value string").write.option("lineSep", " ").text(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path
