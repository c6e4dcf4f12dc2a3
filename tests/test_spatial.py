"""Spatial join: exact closed-intersects results against a brute force, plan shape,
grid-size and partitioning invariance."""
import itertools
import random

from pyspark.sql import functions as F

from geoprep.functions import geometry as G
from geoprep.operators.spatial import first_match, spatial_join


def _poly_df(spark, polys):
    rows = [(pid, name, json_geom(kind, parts)) for pid, name, kind, parts in polys]
    df = spark.createDataFrame(rows, "pid string, name string, gj string")
    return G.parse_gazetteer(df.withColumn("body", F.concat(F.lit('{"geometry":'), "gj", F.lit(',"properties":{}}'))),
                             "body").select("pid", "name", "geometry")


def json_geom(kind, parts):
    import json
    if kind == "Polygon":
        return json.dumps({"type": kind, "coordinates": parts[0]})
    return json.dumps({"type": kind, "coordinates": parts})


def _point_in_ring(px, py, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > py) != (y2 > py):
            cross = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
            if (cross > 0) == (y2 > y1):
                inside = not inside
    return inside


def _on_edge(px, py, ring):
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        cross = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
        if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return True
    return False


def _brute(px, py, parts):
    inside = any(sum(_point_in_ring(px, py, r) for r in p) % 2 == 1 for p in parts)      # parts do not cancel
    return inside or any(_on_edge(px, py, r) for p in parts for r in p)


POLYS = [
    ("A", "square", "Polygon", [[[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]]),
    ("B", "holed", "Polygon", [[[[4, 0], [8, 0], [8, 4], [4, 4], [4, 0]], [[5, 1], [5, 3], [7, 3], [7, 1], [5, 1]]]]),
    ("C", "multi", "MultiPolygon", [[[[0, 4], [2, 4], [2, 6], [0, 6], [0, 4]]], [[[3, 5], [4, 5], [4, 6], [3, 6], [3, 5]]]]),
    ("D", "in hole", "Polygon", [[[[5.5, 1.5], [6.5, 1.5], [6.5, 2.5], [5.5, 2.5], [5.5, 1.5]]]]),
    ("E", "triangle", "Polygon", [[[[10, 0], [14, 0], [12, 3], [10, 0]]]]),
    ("F", "huge", "Polygon", [[[[-100, -100], [100, -100], [100, -50], [-100, -50], [-100, -100]]]]),
    ("G", "star", "Polygon", [[[[20, 0], [21, 2], [23, 2], [21.5, 3], [22, 5], [20, 3.5], [18, 5], [18.5, 3],
                                 [17, 2], [19, 2], [20, 0]]]]),
]


def test_point_in_polygon_matches_brute_force(spark):
    rnd = random.Random(7)
    pts = [(i, rnd.randint(-8, 100) / 4.0, rnd.randint(-8, 28) / 4.0) for i in range(3000)]
    pts += [(10_000 + i, float(x), float(y)) for i, (x, y) in enumerate([(4, 2), (5, 2), (6, 2), (5.5, 1.5), (0, 0), (12, 3),
                                                             (-100, -75), (21.5, 3), (3, 5)])]
    left = spark.createDataFrame(pts, "id long, x double, y double").select("id", G.point("x", "y").alias("geometry"))
    right = _poly_df(spark, POLYS)
    got = {(r["id"], r["pid"]) for r in spatial_join(left, right).collect() if r["pid"]}
    parts = {pid: p for pid, _, kind, p in POLYS}
    want = {(i, pid) for i, x, y in pts for pid, p in parts.items() if _brute(x, y, p)}
    assert got == want
    unmatched = spatial_join(left, right).where(F.col("pid").isNull()).count()
    assert unmatched == len({i for i, _, _ in pts} - {i for i, _ in want})


def test_grid_parameters_do_not_change_the_result(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.randint(-4, 60) / 4.0, rnd.randint(-4, 24) / 4.0) for i in range(800)]
    left = spark.createDataFrame(pts, "id long, x double, y double").select("id", G.point("x", "y").alias("geometry"))
    right = _poly_df(spark, POLYS)
    results = []
    for step, epb in [(1, 32), (2, 2), (3, 1)]:
        results.append(sorted((r["id"], r["pid"]) for r in spatial_join(
            left, right, max_edges=epb).collect()))
    assert results[0] == results[1] == results[2]


def test_polygon_left_geometries(spark):
    shapes = [
        ("p1", "x", "Polygon", [[[[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]]),          # inside A
        ("p2", "x", "Polygon", [[[[-1, -1], [10, -1], [10, 10], [-1, 10], [-1, -1]]]]),  # contains A, B, C, D
        ("p3", "x", "Polygon", [[[[5.75, 1.75], [6.25, 1.75], [6.25, 2.25], [5.75, 2.25], [5.75, 1.75]]]]),  # in D
        ("p4", "x", "Polygon", [[[[5.1, 1.1], [5.2, 1.1], [5.2, 1.2], [5.1, 1.2], [5.1, 1.1]]]]),  # in B's hole only
        ("p5", "x", "LineString", [[[3, 7], [3, -1]]]),                                    # crosses A
        ("p6", "x", "Polygon", [[[[4, 4], [4.5, 4], [4.5, 4.5], [4, 4.5], [4, 4]]]]),       # touches A, B at a vertex
    ]

    def geojson(kind, parts):
        import json
        coords = parts[0] if kind in ("Polygon", "LineString") else parts
        return json.dumps({"type": kind, "coordinates": coords})
    rows = [(sid, geojson(kind, parts)) for sid, _, kind, parts in shapes]
    left = G.parse_gazetteer(spark.createDataFrame(rows, "sid string, gj string").withColumn(
        "body", F.concat(F.lit('{"geometry":'), "gj", F.lit(',"properties":{}}'))), "body").select("sid", "geometry")
    right = _poly_df(spark, POLYS)
    got = {(r["sid"], r["pid"]) for r in spatial_join(left, right).collect() if r["pid"]}
    want = {("p1", "A"), ("p2", "A"), ("p2", "B"), ("p2", "C"), ("p2", "D"), ("p3", "B"), ("p3", "D"),
            ("p2", "E"),                  # p2's right edge x=10 touches E's vertex (10, 0)
            ("p5", "A"), ("p5", "C"),     # the line x=3 crosses A and runs along C's edge x=3
            ("p6", "A"), ("p6", "B")}
    # p3 lies in D, which lies in B's hole: it meets D only
    want.discard(("p3", "B"))
    assert got == want


def test_first_match_keeps_rows_and_picks_by_order(spark):
    left = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 50.0, 50.0)], "id long, x double, y double") \
        .select("id", G.point("x", "y").alias("geometry"))
    right = _poly_df(spark, [("z", "zeta", "Polygon", POLYS[0][3]), ("a", "alpha", "Polygon", POLYS[0][3]),
                             ("n", None, "Polygon", POLYS[0][3])])
    out = first_match(left, right, [F.isnull("name"), F.col("name"), F.col("pid")])
    got = {r["id"]: r["name"] for r in out.collect()}
    assert got == {1: "alpha", 2: "alpha", 3: None}


def test_plan_has_no_cartesian_or_nested_loop(spark):
    left = spark.createDataFrame([(1, 1.0, 1.0)], "id long, x double, y double").select(
        "id", G.point("x", "y").alias("geometry"))
    right = _poly_df(spark, POLYS)
    plan = spatial_join(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_fixture_state_join_agrees_with_jts(spark):
    """Independent geometry oracle: JTS (shipped with Spark) on the driver, for a sample of
    the fixture places against every fixture state polygon (tests only)."""
    from conftest import SF01
    from geoprep.operators import postal as P
    from geoprep.sources import fixtures as FX

    jvm = spark.sparkContext._jvm
    reader = jvm.org.locationtech.jts.io.WKTReader()
    places = P.parse_records(P.gazetteer_records(FX.spr(spark, SF01), FX.geojson(spark, SF01)))
    places = places.where(F.col("geometry").isNotNull()).orderBy("id").limit(300)
    states = FX.adm1(spark, SF01).select(F.col("shapeID").alias("sid"), "geometry")
    got = {(r["id"], r["sid"]) for r in spatial_join(places.select("id", "geometry"), states).collect()
           if r["sid"]}
    pw = [(r["id"], r["wkt"]) for r in places.select("id", G.to_wkt("geometry").alias("wkt")).collect()]
    sw = [(r["sid"], r["wkt"]) for r in states.select("sid", G.to_wkt("geometry").alias("wkt")).collect()]
    sg = [(sid, reader.read(w)) for sid, w in sw]
    want = set()
    for pid, w in pw:
        g = reader.read(w)
        for sid, s in sg:
            if g.intersects(s):
                want.add((pid, sid))
    assert got == want and len(want) > 250


def test_hot_point_copies_keep_exact_multiplicity(spark):
    """A third of all rows are copies of one point (on the shared border of A and B, so
    each copy matches twice); results stay exact and whole."""
    rnd = random.Random(11)
    hot = [(i, 4.0, 2.0) for i in range(1500)]
    rest = [(10_000 + i, rnd.randint(-8, 100) / 4.0, rnd.randint(-8, 28) / 4.0) for i in range(3000)]
    pts = hot + rest
    left = spark.createDataFrame(pts, "id long, x double, y double").select("id", G.point("x", "y").alias("geometry"))
    right = _poly_df(spark, POLYS)
    got = spatial_join(left, right).where(F.col("pid").isNotNull()).groupBy("pid").count()
    got = {r["pid"]: r["count"] for r in got.collect()}
    parts = {pid: p for pid, _, kind, p in POLYS}
    want = {}
    for _, x, y in pts:
        for pid, p in parts.items():
            if _brute(x, y, p):
                want[pid] = want.get(pid, 0) + 1
    assert got == want and got["A"] >= 1500 and got["B"] >= 1500


def test_random_polygons_agree_with_jts(spark):
    import json

    rnd = random.Random(23)
    shapes = []
    for i in range(120):
        x, y = rnd.randint(-4, 96) / 4.0, rnd.randint(-4, 28) / 4.0
        w, h = rnd.randint(0, 12) / 4.0, rnd.randint(0, 12) / 4.0
        if i % 2:
            ring = [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]
        else:
            ring = [[x, y], [x + w, y], [x + w / 2, y + h], [x, y]]
        shapes.append((f"r{i}", json.dumps({"type": "Polygon", "coordinates": [ring]})))
    left = G.parse_gazetteer(spark.createDataFrame(shapes, "sid string, gj string").withColumn(
        "body", F.concat(F.lit('{"geometry":'), "gj", F.lit(',"properties":{}}'))), "body").select("sid", "geometry")
    right = _poly_df(spark, POLYS)
    got = {(r["sid"], r["pid"]) for r in spatial_join(left, right).collect() if r["pid"]}
    reader = spark.sparkContext._jvm.org.locationtech.jts.io.WKTReader()
    lw = [(r["sid"], reader.read(r["w"])) for r in left.select("sid", G.to_wkt("geometry").alias("w")).collect()]
    rw = [(r["pid"], reader.read(r["w"])) for r in right.select("pid", G.to_wkt("geometry").alias("w")).collect()]
    # a collapsed (zero-area, invalid) polygon is taken as the point set of its edges;
    # JTS does not define intersects on invalid input, so compare those with its boundary
    want = {(a, b) for a, ga in lw for b, gb in rw
            if (ga.intersects(gb) if ga.isValid() else ga.getBoundary().intersects(gb))}
    assert got == want and len(want) > 30


def test_without_staging_the_result_is_the_same(spark):
    """The no-staging path (for inputs that are cheap to recompute) gives the same result;
    geometries are built from literals here, not parsed."""
    def lit_geom(kind, parts):
        return G.make(kind, G.literal_parts(parts))

    left = spark.range(1, 4).select(F.col("id"), F.when(F.col("id") == 1, lit_geom("Polygon", [[[(1, 1), (2, 1), (2, 2), (1, 1)]]]))
                                    .when(F.col("id") == 2, lit_geom("Point", [[[(4, 2)]]]))
                                    .otherwise(lit_geom("Point", [[[(50, 50)]]])).alias("geometry"))
    rparts = {"A": [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]], "B": [[[(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]]]}
    right = spark.createDataFrame([("A",), ("B",)], "pid string").select(
        "pid", F.when(F.col("pid") == "A", lit_geom("Polygon", rparts["A"])).otherwise(lit_geom("Polygon", rparts["B"]))
        .alias("geometry"))
    a = sorted(map(tuple, spatial_join(left, right).select("id", "pid").collect()), key=str)
    b = sorted(map(tuple, spatial_join(left, right, stage_mode=None).select("id", "pid").collect()),
               key=str)
    assert a == b == sorted([(1, "A"), (2, "A"), (2, "B"), (3, None)], key=str)


def test_open_lines_empty_parts_and_repeated_ids(spark):
    """A line is not closed into a ring, an empty part is no error, and polygons that share
    an id keep their own edges."""
    t = "struct<kind:string,parts:array<array<array<struct<x:double,y:double>>>>>"
    square = [[(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (0.0, 20.0), (0.0, 0.0)]]
    small = [[(4.0, 5.0), (5.0, 5.0), (5.0, 6.0), (4.0, 6.0), (4.0, 5.0)]]
    right = spark.createDataFrame([("x", "big", ("MultiPolygon", [[], square])), ("x", "small", ("Polygon", [small])),
                                   (None, "far", ("Polygon", [[[(x + 100, y) for x, y in small[0]]]]))], f"id string, name string, geometry {t}")
    left = spark.createDataFrame([(1, ("LineString", [[[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)]]])), (2, ("Point", [[[(4.5, 5.5)]]])),
                                  (3, ("Point", [[[(104.5, 5.5)]]]))], f"k int, geometry {t}")
    got = {(r["k"], r["name"]) for r in spatial_join(left, right).select("k", "name").collect()}
    assert got == {(1, "big"), (2, "big"), (2, "small"), (3, "far")}
