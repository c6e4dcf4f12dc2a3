"""Adaptive cover, parts, collections and layers of the spatial join against brute force."""
import json
import math
import random

from pyspark.sql import functions as F

from geoprep.functions import geometry as G
from geoprep.operators import spatial as S
from geoprep.operators.spatial import index_layers, index_polygons, match_layers, spatial_join
from test_spatial import _brute, _poly_df


def _points(spark, pts):
    return spark.createDataFrame(pts, "id long, x double, y double").select("id", G.point("x", "y").alias("geometry"))


def _hits(df):
    return {(r["id"], r["pid"]) for r in df.collect() if r["pid"]}


def test_overlapping_and_nested_parts_do_not_cancel(spark):
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    polys = [("M", "overlap", "MultiPolygon", [[square(0, 0, 4)], [square(2, 2, 4)]]),
             ("N", "nested", "MultiPolygon", [[square(0, 0, 8)], [square(1, 1, 2)], [square(1, 1, 2)]]),
             ("H", "hole filled", "MultiPolygon", [[square(0, 0, 8), square(2, 2, 4)], [square(3, 3, 2)]])]
    pts = [(k, x / 2, y / 2) for k, (x, y) in enumerate((x, y) for x in range(-2, 20) for y in range(-2, 20))]
    want = {(i, pid) for i, x, y in pts for pid, _, _, parts in polys if _brute(x, y, parts)}
    for max_edges in (1, 3, 64):
        assert _hits(spatial_join(_points(spark, pts), _poly_df(spark, polys), max_edges=max_edges)) == want


def _coast(n, seed, cx=0.0, cy=0.0, size=900.0):
    rnd = random.Random(seed)
    ring = []
    for k in range(n):
        r, a = size * (0.6 + 0.4 * rnd.random()), 2 * math.pi * k / n
        ring.append([round(cx + r * math.cos(a), 3), round(cy + r * math.sin(a), 3)])
    return ring + [ring[0]]


def test_country_with_a_long_coast(spark):
    country = _coast(4000, 1)
    polys = [("C", "country", "MultiPolygon", [[country, _coast(60, 2, 10, 10, 200)], [_coast(40, 3, 2000, 0, 100)]]),
             ("V", "village", "Polygon", [[[[1, 1], [1.5, 1], [1.5, 1.5], [1, 1.5], [1, 1]]]])]
    rnd = random.Random(4)
    pts = [(k, rnd.uniform(-1000, 1000), rnd.uniform(-1000, 1000)) for k in range(300)]
    pts += [(1000 + k, float(x), float(y)) for k, (x, y) in enumerate(country[:200])]                     # on the border
    pts += [(2000 + k, rnd.uniform(1900, 2100), rnd.uniform(-100, 100)) for k in range(100)] + [(3000, 1.2, 1.2)]
    right = _poly_df(spark, polys)
    index = index_polygons(right, max_edges=16)
    held = index.cells.select("inside", F.size(F.flatten(F.transform("parts", lambda p: p["edges"]))).alias("k"))
    most = held.agg(F.max("k")).first()[0]
    assert most <= 16                                                     # no candidate is tested against more edges
    assert held.where("inside").count() > 50                              # much of the country needs no edge test
    assert index.cells.groupBy("lvl", "cx", "cy").count().agg(F.max("count")).first()[0] <= 2
    want = {(i, pid) for i, x, y in pts for pid, _, _, parts in polys if _brute(x, y, parts)}
    assert _hits(spatial_join(_points(spark, pts), index)) == want


def test_many_points_in_one_cell_and_edges_at_one_vertex(spark):
    fan = [("F%d" % k, "x", "Polygon", [[[[0, 0], [8, k], [8, k + 1], [0, 0]]]]) for k in range(30)]
    pts = [(k, (k % 50) / 10, (k % 37) / 10) for k in range(2000)] + [(5000 + k, 0.0, 0.0) for k in range(500)]
    want = {(i, pid) for i, x, y in pts for pid, _, _, parts in fan if _brute(x, y, parts)}
    assert _hits(spatial_join(_points(spark, pts), _poly_df(spark, fan), max_edges=2)) == want


def _collected(spark, rows):
    df = spark.createDataFrame([(i, json.dumps({"geometry": g, "properties": {"mz:postal_locality": "T"}})) for i, g in rows], "id long, body string")
    return G.parse_gazetteer(df, "body")


def test_collections_parse_print_and_join(spark):
    point = {"type": "Point", "coordinates": [1, 1]}
    line = {"type": "LineString", "coordinates": [[20, 0], [20, 9]]}
    area = {"type": "MultiPolygon", "coordinates": [[[[40, 0], [44, 0], [44, 4], [40, 4], [40, 0]]]]}
    coll = lambda *g: {"type": "GeometryCollection", "geometries": list(g)}
    deep = point
    for _ in range(G.COLLECTION_DEPTH + 2):
        deep = coll(deep)
    rows = [(1, coll(point, line, area)), (2, coll(coll(line), point)), (3, coll()), (4, coll(point, {"type": "Circle", "coordinates": [1, 2]})),
            (5, deep), (6, coll(point, None)), (7, {"type": "GeometryCollection"}), (8, point)]
    out = _collected(spark, rows)
    wkt = {r["id"]: (r["w"], r["city"]) for r in out.select("id", "city", G.to_wkt("geometry").alias("w")).collect()}
    assert wkt[1] == ("GEOMETRYCOLLECTION (POINT (1 1), LINESTRING (20 0, 20 9), POLYGON ((40 0, 44 0, 44 4, 40 4, 40 0)))", "T")
    assert wkt[2] == ("GEOMETRYCOLLECTION (LINESTRING (20 0, 20 9), POINT (1 1))", "T")
    assert all(wkt[k] == (None, None) for k in (3, 4, 5, 6, 7)) and wkt[8] == ("POINT (1 1)", "T")
    right = _poly_df(spark, [("P", "at point", "Polygon", [[[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]]),
                             ("L", "on line", "Polygon", [[[[19, 4], [21, 4], [21, 5], [19, 5], [19, 4]]]]),
                             ("A", "in area", "Polygon", [[[[41, 1], [42, 1], [42, 2], [41, 2], [41, 1]]]]),
                             ("X", "line is no ring", "Polygon", [[[[22, 4], [23, 4], [23, 5], [22, 5], [22, 4]]]])])
    assert _hits(spatial_join(out.select("id", "geometry"), right)) == {(1, "P"), (1, "L"), (1, "A"), (2, "L"), (2, "P"), (8, "P")}


def test_layers_are_matched_in_one_pass(spark):
    square = lambda x, s: [[[x, 0], [x + s, 0], [x + s, s], [x, s], [x, 0]]]
    a = _poly_df(spark, [("a1", "one", "Polygon", [square(0, 4)]), ("a1", "one", "Polygon", [square(0, 4)])])
    b = _poly_df(spark, [("b1", "two", "Polygon", [square(2, 4)]), ("b2", None, "Polygon", [square(9, 1)])]).withColumnRenamed("pid", "bid")
    left = _points(spark, [(1, 1.0, 1.0), (2, 3.0, 1.0), (3, 5.0, 1.0), (4, 50.0, 1.0)])
    first, second = match_layers(left, index_layers([a, b]))
    assert sorted((r["__qx"], r["pid"]) for r in first.collect()) == [(1.0, "a1"), (1.0, "a1"), (3.0, "a1"), (3.0, "a1")]      # equal rows each match
    assert sorted((r["__qx"], r["bid"]) for r in second.collect()) == [(3.0, "b1"), (5.0, "b1")]
    empty = index_layers([a.limit(0), b.limit(0)])
    assert [t.count() for t in match_layers(left, empty)] == [0, 0] and S.spatial_join(left, empty, how="left").count() == 4


def test_cover_in_row_prepares_edges_once_a_polygon(spark):
    from geoprep.functions import geometry as G
    from geoprep.operators import cover as C
    ring = [(0, 0), (3, 0), (4, 1), (3, 4), (0, 3), (0, 0)]
    shape = F.struct(F.lit("Polygon").alias("kind"), G.literal_parts([[ring]]).alias("parts"))
    polys = C.boxed(spark.range(3).select(F.col("id").alias("pid"), shape.alias("geom")), "geom", "pid")
    cover = C._cover_in_row(polys)
    per_cell, per_polygon = cover._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)
    assert ".x2 - " not in per_cell and ".x2 - " in per_polygon
    got = {(r["cx"], r["cy"]): r for r in cover.where("pid = 1").collect()}
    edges = got[(0, 0)]["parts"][0]["edges"]
    assert {(e["x1"], e["y1"], e["x2"], e["y2"]) for e in edges} == {(*a, *b) for a, b in zip(ring, ring[1:])}
