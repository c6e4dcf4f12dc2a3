"""Geometry expressions: GeoJSON parse, WKT text, reprojection, malformed input."""
import json
import math

from pyspark.sql import functions as F

from geoprep.functions import geometry as G


def _parse(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id long, body string")
    return {r["id"]: r for r in G.parse_gazetteer(df, "body").select(
        "id", G.to_wkt("geometry").alias("wkt"), "city", "lat_text", "lon_text").collect()}


def test_geojson_kinds_to_wkt(spark):
    geoms = [
        {"type": "Point", "coordinates": [1.5, -2]},
        {"type": "MultiPoint", "coordinates": [[0, 0], [1, 1]]},
        {"type": "LineString", "coordinates": [[0, 0], [1, 0.25]]},
        {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0]], [[2, 2], [3, 3]]]},
        {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [1, 2], [1, 1]]]},
        {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]},
    ]
    bodies = [json.dumps({"geometry": g, "properties": {}}) for g in geoms]
    got = _parse(spark, bodies)
    assert got[0]["wkt"] == "POINT (1.5 -2)"
    assert got[1]["wkt"] == "MULTIPOINT ((0 0), (1 1))"
    assert got[2]["wkt"] == "LINESTRING (0 0, 1 0.25)"
    assert got[3]["wkt"] == "MULTILINESTRING ((0 0, 1 0), (2 2, 3 3))"
    assert got[4]["wkt"] == "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 1 2, 1 1))"
    assert got[5]["wkt"] == "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"


def test_malformed_and_partial_bodies_fail_as_a_whole(spark):
    bodies = [
        "{oops",                                                       # malformed
        json.dumps({"properties": {"geom:latitude": 1}}),               # no geometry
        json.dumps({"geometry": {"type": "Point", "coordinates": [1, 2]}}),  # no properties
        json.dumps({"geometry": {"type": "Circle", "coordinates": [1, 2]}, "properties": {}}),  # unknown type
        json.dumps({"geometry": {"type": "Point", "coordinates": [1, 2]},
                    "properties": {"mz:postal_locality": "Old Town", "geom:latitude": "12.5",
                                   "geom:longitude": 3}}),
    ]
    got = _parse(spark, bodies)
    for i in range(4):
        assert got[i]["wkt"] is None and got[i]["city"] is None and got[i]["lat_text"] is None
    assert got[4]["city"] == "Old Town" and got[4]["lat_text"] == "12.5" and got[4]["lon_text"] == "3"


def test_float_or_nan(spark):
    df = spark.createDataFrame([("12.5",), (None,), ("abc",)], "t string")
    vals = [r[0] for r in df.select(G.to_float_or_nan("t")).collect()]
    assert vals[0] == 12.5 and math.isnan(vals[1]) and math.isnan(vals[2])


def test_wkt_numbers(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, -0.25, 1e-5, 123456789.5, 3.0e20, 0.1)], "v double")
    got = [r[0] for r in df.select(G.wkt_number("v")).collect()]
    assert got == ["1", "-0.25", "0.00001", "123456789.5", "300000000000000000000", "0.1"]


def test_reprojection_round_trip(spark):
    df = spark.createDataFrame([(10.0, 45.0), (-120.25, -33.5)], "x double, y double").select(G.point("x", "y").alias("g"))
    m = G.to_crs(F.col("g"), "EPSG:4326", "EPSG:3857")
    back = G.to_crs(m, "EPSG:3857", "EPSG:4326")
    rows = df.select(G.point_x(m).alias("mx"), G.point_y(m).alias("my"), G.point_x(back).alias("bx"),
                     G.point_y(back).alias("by")).collect()
    assert abs(rows[0]["mx"] - 1113194.9079327357) < 1e-6
    assert abs(rows[0]["my"] - 5621521.486192066) < 1e-6
    assert abs(rows[1]["bx"] + 120.25) < 1e-9 and abs(rows[1]["by"] + 33.5) < 1e-9


def test_gpkg_geometry_codec():
    import struct

    from geoprep.sources.sqlite import decode_gpkg_geometry, encode_gpkg_geometry

    shapes = [("Point", [[[(1.5, -2.0)]]]),
              ("LineString", [[[(0.0, 0.0), (1.0, 2.0)]]]),
              ("Polygon", [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (1.0, 2.0), (1.0, 1.0)]]]),
              ("MultiPoint", [[[(0.0, 0.0)]], [[(1.0, 1.0)]]]),
              ("MultiPolygon", [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]], [[(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)]]])]
    for kind, parts in shapes:
        assert decode_gpkg_geometry(encode_gpkg_geometry(kind, parts)) == (kind, parts)
    # big-endian ISO WKB point Z (1001) behind a header with an xy envelope (flags: envelope 1, LE header)
    wkb = struct.pack(">BIddd", 0, 1001, 3.0, 4.0, 9.0)
    blob = b"GP" + bytes([0, 0b00000011]) + struct.pack("<i", 4326) + struct.pack("<dddd", 3, 3, 4, 4) + wkb
    assert decode_gpkg_geometry(blob) == ("Point", [[[(3.0, 4.0)]]])
    empty = b"GP" + bytes([0, 0b00010001]) + struct.pack("<i", 4326) + struct.pack("<BIdd", 1, 1, 0.0, 0.0)
    assert decode_gpkg_geometry(empty) is None and decode_gpkg_geometry(None) is None


def test_mercator_domain(spark):
    df = spark.createDataFrame([(10.0, 89.0), (10.0, 104.0), (10.0, -95.0)], "x double, y double")
    m = G.to_crs(G.point("x", "y"), "EPSG:4326", "EPSG:3857")
    ys = [r[0] for r in df.select(G.point_y(m)).collect()]
    assert ys[0] is not None and ys[0] > 3e7 and ys[1] is None and ys[2] is None
