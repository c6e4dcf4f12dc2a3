"""Inputs derived from the benchmark tables.

The studied pipeline reads boundary polygons and a postal gazetteer; the test tables hold
neither, so we derive them with integer arithmetic that gives the same rows in Spark and
in DuckDB (coordinates are multiples of 1/4, exact in binary floating point):

* ``adm0`` (countries) from ``nation``; ``adm1`` (states) from ``supplier``; ``adm2``
  (cities) from ``part``; gazetteer records ``spr`` and bodies ``geojson`` from
  ``customer``; quote-like rows from ``events``; keyed-batch rows from ``orders``.
* The layout scales with the tables: states tile a band of 10 columns x (suppliers/10)
  rows of 4x4 tiles; cities (1x1 squares) and places fall into the same tile rows, so a
  place meets about one state and one or two cities whatever the scale factor.

The same formulas, in DuckDB SQL, live in ``geoprep.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoprep.functions import geometry as G

# ---------------------------------------------------------------------------------------
# Fixed values of the fixtures (our own choice): template rings per shape kind, in the
# unit tile; each ring is closed by repeating its first vertex.
SHAPE_TEMPLATES = {
    # octagon
    0: ("Polygon", [[[(1, 0), (3, 0), (4, 1), (4, 3), (3, 4), (1, 4), (0, 3), (0, 1), (1, 0)]]]),
    # square
    1: ("Polygon", [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]]),
    # square with a hole, plus an island inside the hole
    2: ("MultiPolygon", [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]],
                         [[(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5), (1.5, 1.5)]]]),
    # small square (cities)
    3: ("Polygon", [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]]),
}
# ---------------------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _group_code(k: Column) -> Column:
    m = k % 5
    return (F.when(m == 0, "USA").when(m == 1, "GBR").when(m == 2, "DEU").when(m == 3, "FRO")
            .otherwise(F.lit(None).cast("string")))


_MAPS: dict = {}


def _template_maps():
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    hit = _MAPS.get("maps")
    if hit is None or hit[0] is not sc:
        names = F.create_map(*[x for k, (name, _) in SHAPE_TEMPLATES.items() for x in (F.lit(k), F.lit(name))])
        parts = F.create_map(*[x for k, (_, rings) in SHAPE_TEMPLATES.items()
                               for x in (F.lit(k), G.literal_parts(rings))])
        hit = _MAPS["maps"] = (sc, names, parts)
    return hit[1], hit[2]


def shape(kind: Column, x0: Column, y0: Column) -> Column:
    """Geometry of a template shape at offset (x0, y0): one map lookup and one shift."""
    names, parts = _template_maps()
    return F.struct(F.element_at(names, kind.cast("int")).alias("kind"),
                    G.translate(F.element_at(parts, kind.cast("int")), x0, y0).alias("parts"))


def _str(c: Column) -> Column:
    return c.cast("string")


def adm0(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey").cast("long")
    name = (F.when(n % 7 == 6, F.lit(None).cast("string"))
            .when(n % 7 == 5, F.concat(F.lit(" "), F.col("n_name"), F.lit("  MAIN LAND ")))
            .otherwise(F.concat(F.col("n_name"), F.lit(" MAIN  LAND"))))
    x0 = F.lit(-20.0) + F.lit(4.0) * (n % 10)
    y0 = F.lit(-20.0) + F.lit(4.0) * F.floor(n / F.lit(10.0))
    return read(spark, sf_dir, "nation").select(
        _group_code(n).alias("shapeGroup"), F.lit("ADM0").alias("shapeType"), name.alias("shapeName"),
        F.concat(F.lit("C"), _str(n)).alias("shapeID"), shape(n % 3, x0, y0).alias("geometry"))


def adm1(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey").cast("long")
    name = (F.when(s % 8 == 6, F.lit(None).cast("string"))
            .when(s % 8 == 7, F.concat(F.lit(" North  State "), _str(s), F.lit(" ")))
            .otherwise(F.concat(F.lit("State "), _str(s))))
    x0 = F.lit(-20.0) + F.lit(4.0) * (s % 10)
    y0 = F.lit(-20.0) + F.lit(4.0) * F.floor(s / F.lit(10.0))
    return read(spark, sf_dir, "supplier").select(
        _group_code(s).alias("shapeGroup"), F.lit("ADM1").alias("shapeType"), name.alias("shapeName"),
        F.concat(F.lit("S"), _str(s)).alias("shapeID"), shape(s % 3, x0, y0).alias("geometry"))


def adm2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey").cast("long")
    name = F.when(p % 11 == 10, F.lit(None).cast("string")).otherwise(F.concat(F.lit("City "), _str(p % 40)))
    x0 = F.lit(-20.0) + ((p * 37) % 160) / F.lit(4.0)
    y0 = F.lit(-20.0) + F.lit(4.0) * F.floor(p / F.lit(200.0)) + ((p * 53) % 16) / F.lit(4.0)
    return read(spark, sf_dir, "part").select(
        _group_code(p).alias("shapeGroup"), F.lit("ADM2").alias("shapeType"), name.alias("shapeName"),
        F.concat(F.lit("T"), _str(p)).alias("shapeID"), shape(F.lit(3), x0, y0).alias("geometry"))


def boundaries(spark: SparkSession, sf_dir: str) -> dict:
    return {"ADM0": adm0(spark, sf_dir), "ADM1": adm1(spark, sf_dir), "ADM2": adm2(spark, sf_dir)}


def _place_columns(c: Column):
    country = (F.when(c % 5 == 0, "US").when(c % 5 == 1, "USA").when(c % 5 == 2, "CA").when(c % 5 == 3, "US")
               .otherwise(F.lit(None).cast("string")))
    lon = F.lit(-20.5) + ((c * 7919) % 164) / F.lit(4.0)
    lat = F.lit(-20.0) + F.lit(4.0) * F.floor(c / F.lit(150.0)) + ((c * 104729) % 17) / F.lit(4.0)
    return country, lon, lat


def spr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer records: id, country, name (the postal code)."""
    c = F.col("c_custkey").cast("long")
    country, _, _ = _place_columns(c)
    return read(spark, sf_dir, "customer").select(
        c.alias("id"), country.alias("country"), F.lpad(_str(c % 997), 5, "0").alias("name"))


def geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer bodies: id, body (GeoJSON text); every tenth record has none."""
    c = F.col("c_custkey").cast("long")
    _, lon, lat = _place_columns(c)
    slon, slat = _str(lon), _str(lat)
    point = F.concat(F.lit('{"type":"Point","coordinates":['), slon, F.lit(","), slat, F.lit("]}"))
    d = F.lit(0.5)
    square = F.concat(
        F.lit('{"type":"Polygon","coordinates":[['),
        F.concat_ws(",", *[F.concat(F.lit("["), _str(lon + dx), F.lit(","), _str(lat + dy), F.lit("]"))
                           for dx, dy in ((0, 0), (d, 0), (d, d), (0, d), (0, 0))]),
        F.lit("]]}"))
    geom = F.when(c % 50 == 36, square).otherwise(point)
    loc = (F.when(c % 6 == 0, F.concat(F.lit('"mz:postal_locality":"Old  Town '), _str(c % 9), F.lit('",')))
           .when(c % 3 == 0, F.concat(F.lit('"mz:postal_locality":"Old Town '), _str(c % 9), F.lit('",')))
           .otherwise(F.lit("")))
    latp = (F.when(c % 7 == 0, F.lit(""))
            .when(c % 13 == 5, F.concat(F.lit('"geom:latitude":"'), slat, F.lit('",')))
            .otherwise(F.concat(F.lit('"geom:latitude":'), slat, F.lit(","))))
    body = (F.when(c % 50 == 11, F.lit("{oops"))
            .when(c % 50 == 23, F.concat(F.lit('{"properties":{"geom:longitude":'), slon, F.lit("}}")))
            .when(c % 50 == 31, F.concat(F.lit('{"geometry":'), point, F.lit("}")))
            .otherwise(F.concat(F.lit('{"geometry":'), geom, F.lit(',"properties":{'), loc, latp,
                                F.lit('"geom:longitude":'), slon, F.lit("}}"))))
    return read(spark, sf_dir, "customer").where(c % 10 != 9).select(c.alias("id"), body.alias("body"))


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer records (id, geojson_data) whose geometry is a collection: a point, a line and a
    polygon, the last two inside a collection of their own for every second record."""
    c = F.col("c_custkey").cast("long")
    _, x, y = _place_columns(c)

    def at(dx, dy):
        return F.concat(F.lit("["), _str(x + dx), F.lit(","), _str(y + dy), F.lit("]"))

    def path(*steps):
        return F.concat_ws(",", *[at(dx, dy) for dx, dy in steps])

    one = F.concat(F.lit('{"type":"Point","coordinates":'), at(0, 0), F.lit("}"))
    line = F.concat(F.lit('{"type":"LineString","coordinates":['), path((4, 0), (4.5, 0.25)), F.lit("]}"))
    square = F.concat(F.lit('{"type":"MultiPolygon","coordinates":[[['), path((0, 4), (0.5, 4), (0.5, 4.5), (0, 4.5), (0, 4)), F.lit("]]]}"))
    rest = F.concat_ws(",", line, square)
    nested = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), rest, F.lit("]}"))
    members = F.concat_ws(",", one, F.when(c % 2 == 0, nested).otherwise(rest))
    body = F.concat(F.lit('{"geometry":{"type":"GeometryCollection","geometries":['), members, F.lit(']},"properties":{"mz:postal_locality":"Town '),
                    _str(c % 9), F.lit('","geom:latitude":'), _str(y), F.lit(',"geom:longitude":'), _str(x), F.lit("}}"))
    return read(spark, sf_dir, "customer").where(c % 5 == 0).select(c.alias("id"), body.alias("geojson_data"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote-like rows from ``events``: stock_id, symbol, price (float), timestamp."""
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("E"), _str(F.col("event_id"))).alias("stock_id"), F.col("event_type").alias("symbol"),
        F.col("value").cast("float").alias("price"), F.col("ts").alias("timestamp"))


def keyed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed rows from ``orders``: key (o_custkey, o_orderpriority), order (o_orderdate, o_orderkey)."""
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus", "o_totalprice")
