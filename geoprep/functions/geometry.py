"""Geometry as a plain Catalyst value.

A geometry is ``struct<kind:string, parts:array<array<array<struct<x:double,y:double>>>>>``:
part -> ring -> vertex.  For a polygon ring 0 of a part is the shell and the others are
holes; a point is one part with one ring with one vertex; a line string is one part with
one ring; multi-geometries have several parts.  Everything here is built from
higher-order array functions, so it stays inside code generation and needs no Python
worker.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))
GEOM = T.StructType([T.StructField("kind", T.StringType()), T.StructField("parts", PARTS)])

POINT, MULTIPOINT, LINESTRING = "Point", "MultiPoint", "LineString"
MULTILINESTRING, POLYGON, MULTIPOLYGON = "MultiLineString", "Polygon", "MultiPolygon"
AREAL = (POLYGON, MULTIPOLYGON)
#: The kind of a collection names the kind of each of its parts: ``GeometryCollection:Point,Polygon``.
COLLECTION = "GeometryCollection"
COLLECTION_DEPTH = 4          # collections inside collections; deeper ones fail like an unknown type


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vertex(x, y) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


def point(x, y) -> Column:
    """Point geometry from two numeric columns; null when either is null or NaN."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    ok = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    return F.when(ok, F.struct(F.lit(POINT).alias("kind"),
                               F.array(F.array(F.array(vertex(x, y)))).alias("parts")))


def literal_parts(parts) -> Column:
    """Python nested lists ``[[[(x, y), ...], ...], ...]`` -> a literal ``parts`` column."""
    return F.array(*[
        F.array(*[F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
                            for x, y in ring]) for ring in part])
        for part in parts])


def translate(parts, dx, dy) -> Column:
    """Shift every vertex of a ``parts`` column by (dx, dy)."""
    dx, dy = _col(dx).cast("double"), _col(dy).cast("double")
    return F.transform(_col(parts), lambda p: F.transform(p, lambda r: F.transform(
        r, lambda v: F.struct((v["x"] + dx).alias("x"), (v["y"] + dy).alias("y")))))


def make(kind, parts) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), _col(parts).alias("parts"))


def xs(geom) -> Column:
    """All x values of a geometry, flattened."""
    g = _col(geom)
    return F.flatten(F.flatten(F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, lambda v: v["x"])))))


def ys(geom) -> Column:
    g = _col(geom)
    return F.flatten(F.flatten(F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, lambda v: v["y"])))))


def bbox(geom) -> Column:
    """struct<xmin, ymin, xmax, ymax> of a geometry (null for a null geometry)."""
    xv, yv = xs(geom), ys(geom)
    return F.struct(F.array_min(xv).alias("xmin"), F.array_min(yv).alias("ymin"),
                    F.array_max(xv).alias("xmax"), F.array_max(yv).alias("ymax"))


def areal_part(geom, i: Column) -> Column:
    """Whether part ``i`` of a geometry has an inside."""
    kind = _col(geom)["kind"]
    return F.when(is_collection(kind), F.get(part_kinds(kind), i) == POLYGON).otherwise(kind.isin(*AREAL))


def is_collection(kind: Column) -> Column:
    return kind.startswith(COLLECTION)


def part_kinds(kind: Column) -> Column:
    """The kinds of a collection's parts."""
    return F.split(F.substring(kind, len(COLLECTION) + 2, 1 << 30), ",")


def point_x(geom) -> Column:
    """x of the first vertex (lon of a point) (X11)."""
    return _col(geom)["parts"][0][0][0]["x"]


def point_y(geom) -> Column:
    return _col(geom)["parts"][0][0][0]["y"]


# ---------------------------------------------------------------------------------------
# GeoJSON -> geometry

_COORD_SCHEMA = {
    POINT: "array<double>",
    MULTIPOINT: "array<array<double>>",
    LINESTRING: "array<array<double>>",
    MULTILINESTRING: "array<array<array<double>>>",
    POLYGON: "array<array<array<double>>>",
    MULTIPOLYGON: "array<array<array<array<double>>>>",
}


def _pos(c: Column) -> Column:
    """A GeoJSON position [x, y, ...] -> vertex; fewer than two numbers -> null."""
    return F.when(F.size(c) >= 2, F.struct(c[0].alias("x"), c[1].alias("y")))


def _parts_for(kind: str, text: Column) -> Column:
    a = F.from_json(text, _COORD_SCHEMA[kind])
    if kind == POINT:
        return F.when(F.size(a) >= 2, F.array(F.array(F.array(_pos(a)))))
    if kind == MULTIPOINT:
        return F.transform(a, lambda c: F.array(F.array(_pos(c))))
    if kind == LINESTRING:
        return F.array(F.array(F.transform(a, _pos)))
    if kind == MULTILINESTRING:
        return F.transform(a, lambda line: F.array(F.transform(line, _pos)))
    if kind == POLYGON:
        return F.array(F.transform(a, lambda r: F.transform(r, _pos)))
    return F.transform(a, lambda p: F.transform(p, lambda r: F.transform(r, _pos)))


def _valid_parts(parts: Column) -> Column:
    """Null when the coordinates did not parse, are empty or contain a bad position."""
    flat = F.flatten(F.flatten(parts))
    return F.when(parts.isNotNull() & (F.size(flat) > 0) &
                  F.forall(flat, lambda v: v.isNotNull() & v["x"].isNotNull() & v["y"].isNotNull()),
                  parts)


def _raw_parts(kind: Column, text: Column) -> Column:
    branches = None
    for k in _COORD_SCHEMA:
        cond = kind == F.lit(k)
        branches = F.when(cond, _parts_for(k, text)) if branches is None else branches.when(cond, _parts_for(k, text))
    return branches


_MEMBER_SCHEMA = "type string, coordinates string, geometries array<string>"
_SINGLE = {POINT: POINT, MULTIPOINT: POINT, LINESTRING: LINESTRING, MULTILINESTRING: LINESTRING, POLYGON: POLYGON, MULTIPOLYGON: POLYGON}


def _collected(members: Column) -> Column:
    """GeoJSON texts of a collection's members -> struct<kind, parts>, null when one of them
    does not convert.  Collections inside it are opened level by level, and the members of a
    multi-geometry stand as parts of their own."""
    def opened(t):
        m = F.from_json(t, _MEMBER_SCHEMA)
        return F.when(m["type"] == COLLECTION, F.coalesce(m["geometries"], F.array(F.lit(None).cast("string")))).otherwise(F.array(t))

    for _ in range(COLLECTION_DEPTH):
        members = F.flatten(F.transform(members, opened))

    def leaf(t):
        m = F.from_json(t, _MEMBER_SCHEMA)
        single = F.create_map(*[F.lit(x) for kv in _SINGLE.items() for x in kv])
        return F.struct(F.try_element_at(single, m["type"]).alias("kind"), _raw_parts(m["type"], m["coordinates"]).alias("parts"))

    leaves = F.transform(members, leaf)
    kinds = F.flatten(F.transform(leaves, lambda x: F.transform(x["parts"], lambda _: x["kind"])))
    return F.struct(F.concat(F.lit(COLLECTION + ":"), F.array_join(kinds, ",")).alias("kind"),
                    F.flatten(F.transform(leaves, lambda x: x["parts"])).alias("parts"))


def geometry_from_geojson(kind, coordinates_text, geometries=None) -> Column:
    """GeoJSON geometry (type + coordinates as JSON text, or the member texts of a collection)
    -> geometry; unknown type -> null.

    Only the branch of the matching type is evaluated for a row.  (In a DataFrame prefer
    ``parse_gazetteer``, which keeps each step in its own projection.)
    """
    kind, text = _col(kind), _col(coordinates_text)
    parts = _valid_parts(_raw_parts(kind, text))
    simple = F.when(parts.isNotNull(), F.struct(kind.alias("kind"), parts.alias("parts")))
    if geometries is None:
        return simple
    both = _collected(_col(geometries))
    return F.when(kind == COLLECTION, F.when(_valid_parts(both["parts"]).isNotNull(), both)).otherwise(simple)


GAZETTEER_BODY_SCHEMA = "geometry struct<type:string, coordinates:string, geometries:array<string>>, properties map<string,string>"


def parse_gazetteer_body(body) -> Column:
    """One JSON parse of a gazetteer body as a single Column (X6, X7, X13); see
    ``parse_gazetteer`` for the DataFrame form used by the jobs."""
    p = F.from_json(_col(body), GAZETTEER_BODY_SCHEMA)
    geom = geometry_from_geojson(p["geometry"]["type"], p["geometry"]["coordinates"], p["geometry"]["geometries"])
    ok = geom.isNotNull() & p["properties"].isNotNull()
    props = p["properties"]
    return F.when(ok, F.struct(
        geom.alias("geometry"),
        props.getItem("mz:postal_locality").alias("city"),
        props.getItem("geom:latitude").alias("lat_text"),
        props.getItem("geom:longitude").alias("lon_text"),
    )).otherwise(F.struct(
        F.lit(None).cast(GEOM).alias("geometry"), F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("lat_text"), F.lit(None).cast("string").alias("lon_text")))


_PARSE_CACHE: dict = {}


def _parse_exprs():
    """The coordinate-conversion expressions over the fixed helper columns, built once per
    Spark context (they are large; building them costs more than analysing them)."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    hit = _PARSE_CACHE.get("exprs")
    if hit is None or hit[0] is not sc:
        hit = _PARSE_CACHE["exprs"] = (sc, _raw_parts(F.col("__gk"), F.col("__gz.geometry.coordinates")),
                                       _valid_parts(F.col("__gp")),
                                       F.when(F.col("__gk") == COLLECTION, _collected(F.col("__gz.geometry.geometries"))))
    return hit[1:]


def parse_gazetteer(df, body_col: str):
    """Adds ``geometry``, ``city``, ``lat_text``, ``lon_text`` parsed from a gazetteer body.

    One JSON parse per row.  A body that is malformed, has no ``geometry`` or no
    ``properties`` object, or whose geometry does not convert, fails as a whole record:
    every added column is null.  Property names contain ``:``, so they are map keys.
    Each step is its own projection, so no large expression is copied into several
    places of the plan.
    """
    raw, valid, collected = _parse_exprs()
    df = df.withColumn("__gz", F.from_json(F.col(body_col), GAZETTEER_BODY_SCHEMA))
    df = df.withColumn("__gk", F.col("__gz.geometry.type"))
    df = df.withColumns({"__gp": raw, "__gc": collected})
    df = df.withColumns({"__gk": F.coalesce("__gc.kind", "__gk"), "__gp": F.coalesce("__gc.parts", "__gp")})
    df = df.withColumn("__gp", valid)
    ok = F.col("__gp").isNotNull() & F.col("__gz.properties").isNotNull()
    df = df.withColumn("__ok", ok)
    props = F.col("__gz.properties")
    df = df.withColumns({
        "geometry": F.when(F.col("__ok"), F.struct(F.col("__gk").alias("kind"), F.col("__gp").alias("parts"))),
        "city": F.when(F.col("__ok"), props.getItem("mz:postal_locality")),
        "lat_text": F.when(F.col("__ok"), props.getItem("geom:latitude")),
        "lon_text": F.when(F.col("__ok"), props.getItem("geom:longitude")),
    })
    return df.drop("__gz", "__gk", "__gp", "__gc", "__ok")


def to_float_or_nan(text) -> Column:
    """Text -> double; missing or not a number -> NaN."""
    return F.coalesce(_col(text).try_cast("double"), F.lit(float("nan")))


# ---------------------------------------------------------------------------------------
# geometry -> WKT


def wkt_number(c) -> Column:
    """Shortest decimal text of a double without exponent; integral values lose ``.0``."""
    c = _col(c)
    plain = F.regexp_replace(F.regexp_replace(F.replace(F.format_number(c, 30), F.lit(","), F.lit("")),
                                              r"0+$", ""), r"\.$", "")
    return (F.when(F.isnan(c), F.lit("NaN"))
            .when((c == F.floor(c)) & (F.abs(c) < F.lit(1e15)), c.cast("long").cast("string"))
            .when((F.abs(c) >= F.lit(1e-3)) & (F.abs(c) < F.lit(1e7)), c.cast("string"))
            .otherwise(plain))


_WKT_PREFIX = {POINT: "POINT ", LINESTRING: "LINESTRING ", POLYGON: "POLYGON ", MULTIPOINT: "MULTIPOINT ",
               MULTILINESTRING: "MULTILINESTRING ", MULTIPOLYGON: "MULTIPOLYGON "}
_WKT_CACHE: dict = {}


def _wkt_expr(g: Column) -> Column:
    # vertex texts are built once; the kinds only differ in how rings and parts are joined
    rings = F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.concat(
        F.lit("("), F.array_join(F.transform(r, lambda v: F.concat(wkt_number(v["x"]), F.lit(" "),
                                                                   wkt_number(v["y"]))), ", "), F.lit(")"))))
    kind = g["kind"]
    first_rings = F.transform(rings, lambda p: p[0])
    polys = F.transform(rings, lambda p: F.concat(F.lit("("), F.array_join(p, ", "), F.lit(")")))
    body = (F.when(kind.isin(POINT, LINESTRING), rings[0][0])
            .when(kind == POLYGON, polys[0])
            .when(kind.isin(MULTIPOINT, MULTILINESTRING), F.concat(F.lit("("), F.array_join(first_rings, ", "), F.lit(")")))
            .when(kind == MULTIPOLYGON, F.concat(F.lit("("), F.array_join(polys, ", "), F.lit(")"))))
    prefix = F.create_map(*[F.lit(x) for kv in _WKT_PREFIX.items() for x in kv])
    members = F.zip_with(part_kinds(kind), rings, lambda k, p: F.concat(F.try_element_at(prefix, k), F.when(
        k == POLYGON, F.concat(F.lit("("), F.array_join(p, ", "), F.lit(")"))).otherwise(p[0])))
    whole = F.concat(F.lit("GEOMETRYCOLLECTION ("), F.array_join(members, ", "), F.lit(")"))
    return F.when(is_collection(kind), whole).when(g.isNotNull(), F.concat(F.try_element_at(prefix, kind), body))


def to_wkt(geom) -> Column:
    """Geometry -> WKT text; null geometry -> null."""
    if isinstance(geom, str):
        from pyspark import SparkContext

        sc = SparkContext._active_spark_context
        hit = _WKT_CACHE.get(geom)
        if hit is None or hit[0] is not sc:     # the entry holds its context, so ids are not reused
            hit = _WKT_CACHE[geom] = (sc, _wkt_expr(F.col(geom)))
        return hit[1]
    return _wkt_expr(geom)


# ---------------------------------------------------------------------------------------
# Coordinate reference systems

EARTH_RADIUS = 6378137.0
WGS84, WEB_MERCATOR = "EPSG:4326", "EPSG:3857"


def _map_vertices(geom: Column, fx, fy) -> Column:
    return F.when(geom.isNotNull(), F.struct(geom["kind"].alias("kind"), F.transform(
        geom["parts"], lambda p: F.transform(p, lambda r: F.transform(
            r, lambda v: F.struct(fx(v["x"], v["y"]).alias("x"), fy(v["x"], v["y"]).alias("y"))))).alias("parts")))


def to_crs(geom, source: str, target: str) -> Column:
    """Reproject between EPSG:4326 and EPSG:3857 with the closed forms; same CRS -> as is."""
    g = _col(geom)
    source, target = source.upper(), target.upper()
    if source == target:
        return g
    if (source, target) == (WGS84, WEB_MERCATOR):
        k = math.pi / 180.0
        # Web Mercator is undefined outside [-90, 90] degrees of latitude: such a y is null
        return _map_vertices(
            g, lambda x, y: x * F.lit(EARTH_RADIUS * k),
            lambda x, y: F.when(F.abs(y) <= F.lit(90.0),
                                F.log(F.tan(F.lit(math.pi / 4) + y * F.lit(k / 2))) * F.lit(EARTH_RADIUS)))
    if (source, target) == (WEB_MERCATOR, WGS84):
        return _map_vertices(
            g, lambda x, y: x / F.lit(EARTH_RADIUS) * F.lit(180.0 / math.pi),
            lambda x, y: (F.lit(2.0) * F.atan(F.exp(y / F.lit(EARTH_RADIUS))) - F.lit(math.pi / 2)) * F.lit(180.0 / math.pi))
    raise ValueError(f"unsupported CRS pair {source} -> {target}")
