import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import parse_currency, parse_timestamp
from tessera.sources import ingest


def test_currency_parse(spark):
    df = spark.createDataFrame([("$33,887",), ("$1,234",), ("",), ("N/A",), (None,)], "v string")
    assert [r[0] for r in df.select(parse_currency("v")).collect()] == [33887, 1234, None, None, None]


def test_timestamp_parse_12h(spark):
    df = spark.createDataFrame([("01/08/2020 12:00:00 AM",), ("01/08/2020 12:00:00 PM",), ("garbage",)], "v string")
    got = [r[0] for r in df.select(parse_timestamp("v").cast("timestamp_ntz")).collect()]
    assert [g.hour if g else None for g in got] == [0, 12, None]


def test_clean_incidents_idempotent(spark):
    df = spark.createDataFrame([("03/01/2020 01:30:00 PM", "7")], "`DATE OCC` string, `AREA ` string")
    once = ingest.clean_incidents(df, ts_columns=("DATE OCC", "Date Rptd"))
    twice = ingest.clean_incidents(once, ts_columns=("DATE OCC", "Date Rptd"))
    assert once.columns == ["DATE OCC", "AREA"] and twice.columns == ["DATE OCC", "AREA"]
    assert once.collect() == twice.collect()


def test_csv_quoted_commas_and_bom(spark, tmp_dir):
    p = os.path.join(tmp_dir, "income.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('"Zip Code","Community","Estimated Median Income"\n')
        f.write('90001,"Riverside (North Side, Old Town), Hillcrest","$33,887"\n')
    inc = ingest.clean_income(ingest.read_csv(spark, p))
    row = inc.collect()[0]
    assert row["Community"].endswith("Hillcrest") and row["Estimated Median Income"] == 33887
    b = os.path.join(tmp_dir, "stations.csv")
    with open(b, "wb") as f:
        f.write("﻿X,Y,FID,DIVISION\n1.5,2.5,1,NORTHSIDE\n".encode("utf-8"))
    st = ingest.read_csv(spark, b)
    assert st.columns[0] == "X" and st.collect()[0]["DIVISION"] == "NORTHSIDE"


def test_csv_no_header_and_text(spark, tmp_dir):
    p = os.path.join(tmp_dir, "emp.csv")
    with open(p, "w") as f:
        f.write("1,Mara K,2000,1\n2,Ann,1500,2\n")
    df = ingest.read_csv_no_header(spark, p, "id int, name string, salary float, dep_id int")
    assert [r["name"] for r in df.orderBy("salary").collect()] == ["Ann", "Mara K"]
    t = os.path.join(tmp_dir, "t.txt")
    with open(t, "w") as f:
        f.write("a b\nc\n")
    assert ingest.read_text_lines(spark, t).count() == 2


def test_parquet_roundtrip_keeps_partitions(spark, tmp_dir):
    df = spark.range(1000).repartition(4)
    out = ingest.write_parquet(df, os.path.join(tmp_dir, "p"))
    assert spark.read.parquet(out).count() == 1000
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) > 1


def _fc(features):
    return {"type": "FeatureCollection", "features": features}


def test_geojson_polygon_and_multipolygon(spark, tmp_dir):
    sq = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    feats = [
        {"type": "Feature", "properties": {"COMM": "A", "POP_2010": 3}, "geometry": {"type": "Polygon", "coordinates": sq}},
        {"type": "Feature", "properties": {"COMM": "B", "POP_2010": 4},
         "geometry": {"type": "MultiPolygon", "coordinates": [sq, [[[2, 2], [3, 2], [3, 3], [2, 2]]]]}},
        {"type": "Feature", "properties": {"COMM": "C", "POP_2010": 0}, "geometry": None},
    ]
    p = os.path.join(tmp_dir, "blocks.geojson")
    with open(p, "w") as f:
        json.dump(_fc(feats), f, indent=2)
    props = spark.createDataFrame([], "COMM string, POP_2010 long").schema
    df = ingest.read_geojson(spark, p, props, multi_line=True)
    rows = {r["COMM"]: r for r in df.collect()}
    assert rows["A"]["geometry_type"] == "Polygon" and len(rows["A"]["geometry"]) == 1
    assert rows["B"]["geometry_type"] == "MultiPolygon" and len(rows["B"]["geometry"]) == 2
    assert rows["C"]["geometry"] is None
    # one FeatureCollection per line reads the same features, split across tasks
    lp = os.path.join(tmp_dir, "lines.geojson")
    with open(lp, "w") as f:
        f.write(json.dumps(_fc(feats[:1])) + "\n" + json.dumps(_fc(feats[1:])) + "\n")
    assert ingest.read_geojson(spark, lp, props, multi_line=False).count() == 3
    # a GeoJSON text sequence: one bare Feature per line
    sp = os.path.join(tmp_dir, "seq.geojson")
    with open(sp, "w") as f:
        f.write("\n".join(json.dumps(ft) for ft in feats) + "\n")
    seq = {r["COMM"]: r for r in ingest.read_geojson(spark, sp, props, multi_line=False).collect()}
    assert seq["B"]["geometry_type"] == "MultiPolygon" and len(seq["B"]["geometry"]) == 2 and len(seq) == 3


def test_drop_missing_coordinates_keeps_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0), (None, 1.0), (1.0, None), (2.0, 3.0)], "LON double, LAT double")
    assert ingest.drop_missing_coordinates(df).count() == 2
    assert ingest.drop_missing_coordinates(df).filter(F.col("LON") == 0).count() == 1


def test_geojson_properties_are_discovered(spark, tmp_dir):
    path = f"{tmp_dir}/features.json"
    with open(path, "w") as f:
        f.write('{"type": "FeatureCollection", "features": [\n'
                '{"type": "Feature", "properties": {"name": "a", "people": 3}, "geometry": {"type": "Polygon", '
                '"coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},\n'
                '{"type": "Feature", "properties": {"name": "b", "area": 1.5}, "geometry": {"type": "MultiPolygon", '
                '"coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}}]}')
    rows = ingest.read_geojson(spark, path)
    assert dict(rows.drop("geometry").dtypes) == {"name": "string", "people": "bigint", "area": "double", "geometry_type": "string"}
    assert {(r["name"], r["people"], r["area"], len(r["geometry"])) for r in rows.collect()} == {("a", 3, None, 1), ("b", None, 1.5, 1)}


def test_known_files_have_declared_schemas(spark, tmp_dir):
    with open(f"{tmp_dir}/income.csv", "w", encoding="utf-8-sig") as f:
        f.write('Zip Code,Community,Estimated Median Income\n90001,"Los Angeles (South), Florence","$33,887"\n90002,,\n')
    rows = {r["Zip Code"]: r for r in ingest.read_income(spark, f"{tmp_dir}/income.csv").collect()}
    assert rows[90001]["Estimated Median Income"] == 33887 and rows[90002]["Estimated Median Income"] is None
    names = [n.strip("`") for n in ("DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA ", "AREA NAME")]
    rest = spark.createDataFrame([], ingest.INCIDENTS).columns
    assert rest[:6] == names and len(rest) == 28
    with open(f"{tmp_dir}/incidents.csv", "w") as f:
        f.write(",".join(rest) + "\n" + "1,01/02/2020 12:00:00 AM,01/01/2020 11:30:00 PM,2330,7,West" + "," * 20 + ",34.05,-118.25\n")
    one, = ingest.read_incidents(spark, f"{tmp_dir}/incidents.csv").collect()
    assert (one["AREA"], one["DATE OCC"].hour, one["LAT"], one["LON"]) == (7, 23, 34.05, -118.25)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("split", [600, 7000, None])
def test_one_document_is_read_by_many_tasks(spark, tmp_dir, indent, split):
    """Braces, quotes, backslashes and line breaks in strings; objects beside the features; any layout and any cut."""
    r = random.Random(1)
    features = [{"properties": {"id": i, "s": "".join(r.choice('a{}"\\é\n x') for _ in range(r.randrange(40))), "o": {"k": [1, {"z": 2}]}},
                 "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i, 1], [i + 1, 1], [i, 0]]]}} for i in range(300)]
    document = {"crs": {"a": {"b": "}{"}}, "type": "FeatureCollection", "features": features, "tail": {"q": 1}}
    os.makedirs(f"{tmp_dir}/in")
    for name, own in (("a", document), ("b", {"type": "FeatureCollection", "features": []}), ("c", {**document, "features": features[:1]})):
        with open(f"{tmp_dir}/in/{name}.geojson", "w", encoding="utf-8") as f:
            f.write(json.dumps(own, indent=indent, ensure_ascii=False) + "\n")
    schema = spark.createDataFrame([], "id int, s string").schema
    back = ingest.read_geojson_document(spark, f"{tmp_dir}/in", schema, split_bytes=split)
    got = sorted((x["id"], x["s"], x["geometry"][0][0][2][0]) for x in back.collect())
    assert got == sorted((f["properties"]["id"], f["properties"]["s"], f["properties"]["id"] + 1.0) for f in [*features, features[0]])
    whole = ingest.read_geojson(spark, f"{tmp_dir}/in", schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, whole.collect()))


def test_a_document_is_scanned_in_ranges(spark, tmp_dir):
    with open(f"{tmp_dir}/d.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": i}, "geometry": None} for i in range(2000)]}, f)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "20000")
        assert spark.read.option("lineSep", "}").text(f"{tmp_dir}/d.geojson").rdd.getNumPartitions() > 4
        assert ingest.document_features(spark, f"{tmp_dir}/d.geojson").count() == 2000
    finally:
        spark.conf.set(name, before)
    assert spark.conf.get(name) == before


def test_a_document_is_measured_in_one_pass(spark, tmp_dir, monkeypatch):
    sorts = []
    order = type(spark.range(1)).orderBy
    monkeypatch.setattr(type(spark.range(1)), "orderBy", lambda self, *a, **kw: sorts.append(a) or order(self, *a, **kw))
    text = json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"note": note}, "geometry": None} for note in ('a "q\\{" }', "\\", '\\"}{', "", "\\\\")] * 40})
    with open(f"{tmp_dir}/d.json", "w") as f:
        f.write(text)
    back = ingest.read_geojson_document(spark, f"{tmp_dir}/d.json", spark.createDataFrame([], "note string").schema, split_bytes=700)
    assert sorted(r["note"] for r in back.collect()) == sorted(['a "q\\{" }', "\\", '\\"}{', "", "\\\\"] * 40)
    assert not sorts  # a sort of the ranges reads the document once more
