"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator, and the
matching DuckDB oracle SQL.  Keys are ``<id>_<slug>`` after the operator inventory."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from geoprep.functions import geometry as G
from geoprep.operators import boundary as B
from geoprep.operators import postal as P
from geoprep.operators.spatial import first_match, spatial_join
from geoprep.plans import oracle as O
from geoprep.sources import fixtures as FX

QUERIES: dict = {}
ORACLE: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql() if callable(sql) else sql
        return fn
    return deco


def _places(spark, d):
    """Parsed gazetteer places, staged once (as the postal job does)."""
    from geoprep.operators.stage import stage
    return stage(P.parse_records(P.gazetteer_records(FX.spr(spark, d), FX.geojson(spark, d))))


# ---------------------------------------------------------------------------------------
# W4 postal enrichment (flagship) and its spatial joins


@register("w4_enrich_postal", lambda: O.postal_sql() + "SELECT * FROM postal")
def w4_enrich_postal(spark, d):
    return P.enrich_postal(FX.spr(spark, d), FX.geojson(spark, d), FX.adm1(spark, d), FX.adm2(spark, d))


@register("j2_spatial_state", lambda: O.with_ctes(
    O.fixture_ctes(), O.polygon_ctes("st", "adm1_raw"), O.places_ctes(), O.hits_cte("st_hits", "st")) + """
SELECT p.id, a.shapeID AS state_id, a.shapeName AS state
FROM places p LEFT JOIN st_hits h ON h.wkt = p.wkt LEFT JOIN adm1_raw a ON a.shapeID = h.rid""")
def j2_spatial_state(spark, d):
    places = _places(spark, d).select("id", "geometry")
    states = FX.adm1(spark, d).select(F.col("shapeID").alias("state_id"), F.col("shapeName").alias("state"), "geometry")
    return spatial_join(places, states, how="left").select("id", "state_id", "state")


@register("j3_spatial_city", lambda: O.with_ctes(
    O.fixture_ctes(), O.polygon_ctes("ct", "adm2_raw"), O.places_ctes(), O.hits_cte("ct_hits", "ct")) + """
SELECT DISTINCT p.wkt AS wkt_geometry, a.shapeID AS city_id, a.shapeName AS city
FROM places p LEFT JOIN ct_hits h ON h.wkt = p.wkt LEFT JOIN adm2_raw a ON a.shapeID = h.rid""")
def j3_spatial_city(spark, d):
    geoms = _places(spark, d).select("geometry").distinct()
    cities = FX.adm2(spark, d).select(F.col("shapeID").alias("city_id"), F.col("shapeName").alias("city"), "geometry")
    out = spatial_join(geoms, cities, how="left")
    return out.select(G.to_wkt("geometry").alias("wkt_geometry"), "city_id", "city")


@register("a4_city_first_per_geometry", lambda: O.with_ctes(
    O.fixture_ctes(), O.polygon_ctes("ct", "adm2_raw"), O.places_ctes(), O.hits_cte("ct_hits", "ct")) + """
SELECT g.wkt AS wkt_geometry, pick.city_id, pick.city
FROM (SELECT DISTINCT wkt FROM places WHERE wkt IS NOT NULL) g LEFT JOIN (
  SELECT wkt, city_id, city FROM (
    SELECT h.wkt, a.shapeID AS city_id, a.shapeName AS city,
           row_number() OVER (PARTITION BY h.wkt ORDER BY a.shapeName IS NULL, a.shapeName, a.shapeID) AS rn
    FROM ct_hits h JOIN adm2_raw a ON a.shapeID = h.rid) WHERE rn = 1) pick ON pick.wkt = g.wkt""")
def a4_city_first_per_geometry(spark, d):
    geoms = _places(spark, d).where(F.col("geometry").isNotNull()).select("geometry").distinct()
    cities = FX.adm2(spark, d).select(F.col("shapeID").alias("city_id"), F.col("shapeName").alias("city"), "geometry")
    out = first_match(geoms, cities, [F.isnull("city"), F.col("city"), F.col("city_id")])
    return out.select(G.to_wkt("geometry").alias("wkt_geometry"), "city_id", "city")


# ---------------------------------------------------------------------------------------
# Boundary levels (W1 pieces)


def _level_sql(level: str) -> str:
    raw = {"ADM0": "adm0_raw", "ADM1": "adm1_raw", "ADM2": "adm2_raw"}[level]
    wkt = O.polygon_ctes("lv", raw)
    if level == "ADM0":
        body = """SELECT coalesce(CASE shapeGroup WHEN 'USA' THEN 'US' WHEN 'GBR' THEN 'GB' WHEN 'DEU' THEN 'DE'
  WHEN 'FRA' THEN 'FR' WHEN 'ESP' THEN 'ES' WHEN 'ITA' THEN 'IT' WHEN 'NLD' THEN 'NL' WHEN 'CHN' THEN 'CN'
  WHEN 'JPN' THEN 'JP' WHEN 'CAN' THEN 'CA' WHEN 'AUS' THEN 'AU' WHEN 'BRA' THEN 'BR' WHEN 'IND' THEN 'IN'
  WHEN 'RUS' THEN 'RU' WHEN 'MEX' THEN 'MX' WHEN 'ZAF' THEN 'ZA' END, shapeGroup) AS country_code,
  replace(shapeName, ' ', '_') AS country_full_name, shapeType AS gadm_level FROM adm0_raw"""
    elif level == "ADM1":
        body = """SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS state, a.shapeID,
  shapeType AS gadm_level, w.wkt AS wkt_geometry_state
FROM adm1_raw a LEFT JOIN lv_wkt w ON w.rid = a.shapeID WHERE shapeName IS NOT NULL"""
    else:
        body = """SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS city, shapeID,
  shapeType AS gadm_level FROM adm2_raw WHERE shapeName IS NOT NULL"""
    return O.with_ctes(O.fixture_ctes(), wkt) + "\n" + body


for _lvl in ("ADM0", "ADM1", "ADM2"):
    def _make(level):
        def q(spark, d):
            return B.prepare_level(FX.boundaries(spark, d)[level], level)
        return q
    register(f"w1_prepare_{_lvl.lower()}", _level_sql(_lvl))(_make(_lvl))


# =======================================================================================
# Shared SQL pieces

def _sql(*ctes, body: str) -> str:
    return O.with_ctes(*ctes) + "\n" + body


FIX = O.fixture_ctes()
PLACES = O.places_ctes()
ADM0_MAP_SQL = """coalesce(CASE {c} WHEN 'USA' THEN 'US' WHEN 'GBR' THEN 'GB' WHEN 'DEU' THEN 'DE'
  WHEN 'FRA' THEN 'FR' WHEN 'ESP' THEN 'ES' WHEN 'ITA' THEN 'IT' WHEN 'NLD' THEN 'NL' WHEN 'CHN' THEN 'CN'
  WHEN 'JPN' THEN 'JP' WHEN 'CAN' THEN 'CA' WHEN 'AUS' THEN 'AU' WHEN 'BRA' THEN 'BR' WHEN 'IND' THEN 'IN'
  WHEN 'RUS' THEN 'RU' WHEN 'MEX' THEN 'MX' WHEN 'ZAF' THEN 'ZA' END, {c})"""
ADM1_SQL = _level_sql("ADM1")
ADM2_SQL = _level_sql("ADM2")
ADM0_SQL = _level_sql("ADM0")
POSTAL_CTES = O.postal_sql()


def _postal(spark, d):
    return P.enrich_postal(FX.spr(spark, d), FX.geojson(spark, d), FX.adm1(spark, d), FX.adm2(spark, d))


def _scratch(spark, name):
    from geoprep.session import scratch_dir
    return scratch_dir(spark, name)


def _combined_sql() -> str:
    """W3 in SQL: the three combined-variant levels unioned by name, first per key."""
    return _sql(FIX, O.polygon_ctes("w0", "adm0_raw"), O.polygon_ctes("w1", "adm1_raw"),
                O.polygon_ctes("w2", "adm2_raw"), """
u AS (
  SELECT shapeGroup, shapeType, replace(shapeName, ' ', '_') AS city, shapeID, w.wkt AS wkt_geometry_city,
         'ADM2' AS gadm_level, NULL AS state, NULL AS wkt_geometry_state, NULL AS country,
         NULL AS country_full_name, NULL AS wkt_geometry_country, 2 AS depth
  FROM adm2_raw a LEFT JOIN w2_wkt w ON w.rid = a.shapeID
  UNION ALL
  SELECT shapeGroup, shapeType, NULL, shapeID, NULL, 'ADM1', replace(shapeName, ' ', '_'), w.wkt, NULL, NULL, NULL, 1
  FROM adm1_raw a LEFT JOIN w1_wkt w ON w.rid = a.shapeID
  UNION ALL
  SELECT NULL, shapeType, NULL, shapeID, NULL, 'ADM0', NULL, NULL, """ + ADM0_MAP_SQL.format(c="shapeGroup") + """,
         replace(shapeName, ' ', '_'), w.wkt, 0
  FROM adm0_raw a LEFT JOIN w0_wkt w ON w.rid = a.shapeID),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY shapeGroup, country, state, city
                               ORDER BY depth DESC, shapeID NULLS FIRST,
                                        coalesce(city, state, country_full_name) NULLS FIRST) AS rn
  FROM u)""", body="""SELECT shapeGroup, shapeType, city, shapeID, wkt_geometry_city, gadm_level, state,
  wkt_geometry_state, country, country_full_name, wkt_geometry_country FROM ranked WHERE rn = 1""")


# =======================================================================================
# §2.1 scans and sources

@register("s1_gpkg_boundary_scan", ADM1_SQL)
def s1_gpkg_boundary_scan(spark, d):
    """Boundary level written as GeoPackage files, read back through the gpkg source."""
    from geoprep.sources.sqlite import read_features, write_feature_files
    folder = _scratch(spark, "adm1-gpkg")
    write_feature_files(FX.adm1(spark, d), folder, "adm1").collect()
    raw = read_features(spark, folder, table="adm1", columns=["shapeGroup", "shapeType", "shapeName", "shapeID",
                                                              "geometry"])
    return B.prepare_level(raw, "ADM1")


@register("s1b_gpkg_box_scan", _sql(FIX, body="""
, ext AS (SELECT kind, min(x) AS w, max(x) AS e, min(y) AS s, max(y) AS n FROM shape_tpl GROUP BY kind)
SELECT a.shapeID, a.shapeName FROM adm2_raw a JOIN ext USING (kind)
WHERE x0 + w <= 3.5 AND x0 + e >= -2 AND y0 + s <= 1.25 AND y0 + n >= -6 AND shapeName IS NOT NULL"""))
def s1b_gpkg_box_scan(spark, d):
    """The city polygons of GeoPackage files whose boxes meet a box: the files' R-tree tables say
    which rows are read."""
    from geoprep.sources.sqlite import read_features, write_feature_files
    folder = _scratch(spark, "adm2-gpkg")
    write_feature_files(FX.adm2(spark, d), folder, "adm2").collect()
    return read_features(spark, folder, table="adm2", columns=["shapeID", "shapeName"], rows_per_partition=500,
                         box=(-2, -6, 3.5, 1.25)).where("shapeName IS NOT NULL")


@register("s3_sqlite_table_scan", _sql(FIX, body="""
SELECT s.id, s.country, s.name AS postal_code, g.body AS geojson_data
FROM spr s JOIN geojson g ON s.id = g.id WHERE s.country IN ('USA', 'US')"""))
def s3_sqlite_table_scan(spark, d):
    """Gazetteer tables ``spr`` and ``geojson`` in SQLite files, read as two tables."""
    from geoprep.sources.sqlite import read_features, write_feature_files
    folder = _scratch(spark, "gazetteer-sqlite")
    write_feature_files(FX.spr(spark, d), f"{folder}/spr", "spr").collect()
    write_feature_files(FX.geojson(spark, d), f"{folder}/geojson", "geojson").collect()
    spr = read_features(spark, f"{folder}/spr", table="spr", columns=["id", "country", "name"])
    body = read_features(spark, f"{folder}/geojson", table="geojson", columns=["id", "body"])
    return P.gazetteer_records(spr, body)


@register("s2_skip_missing_source", """
SELECT 'supplier' AS source, 'loaded' AS status, CAST(count(*) AS BIGINT) AS rows FROM supplier
UNION ALL SELECT 'absent', 'skipped', CAST(NULL AS BIGINT)""")
def s2_skip_missing_source(spark, d):
    from geoprep.sources.tables import load_or_skip
    out = []
    for name in ("supplier", "absent"):
        df, rep = load_or_skip(spark, f"{d.rstrip('/')}/{name}.parquet")
        if df is not None:
            counted = df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("source"), F.lit(rep["status"]).alias("status"), "rows")
        else:
            counted = spark.range(1).select(F.lit(name).alias("source"), F.lit(rep["status"]).alias("status"),
                                            F.lit(None).cast("long").alias("rows"))
        out.append(counted)
    return out[0].unionByName(out[1])


@register("s4_parquet_scan", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def s4_parquet_scan(spark, d):
    from geoprep.sources.tables import read_table
    return read_table(spark, f"{d}/customer.parquet", columns=["c_custkey", "c_name", "c_nationkey"])


@register("s5_table_scan_projection", _sql(FIX, body=f"SELECT {ADM0_MAP_SQL.format(c='shapeGroup')} AS country_code FROM adm0_raw"))
def s5_table_scan_projection(spark, d):
    from geoprep.sources.tables import read_table, write_table
    gadm0 = B.prepare_level(FX.adm0(spark, d), "ADM0")
    path = _scratch(spark, "gadm0")
    write_table(gadm0, path, mode="overwrite")
    return read_table(spark, path, columns=["country_code"])


@register("s6_source_projection", lambda: _sql(FIX, O.polygon_ctes("st", "adm1_raw"),
          body="SELECT a.shapeName AS state, w.wkt AS wkt FROM adm1_raw a LEFT JOIN st_wkt w ON w.rid = a.shapeID"))
def s6_source_projection(spark, d):
    s = P.state_polygons(FX.adm1(spark, d))
    return s.select("state", G.to_wkt("geometry").alias("wkt"))


# =======================================================================================
# §2.2 sinks

@register("k1_overwrite_partitioned", ADM1_SQL)
def k1_overwrite_partitioned(spark, d):
    from geoprep.sources.tables import read_back, write_table
    gadm1 = B.prepare_level(FX.adm1(spark, d), "ADM1")
    path = _scratch(spark, "gadm1")
    write_table(gadm1, path, mode="overwrite", partition_by=["country_code"])
    write_table(gadm1, path, mode="overwrite", partition_by=["country_code"])
    return read_back(spark, path, gadm1)


@register("k2_append_mode_guard", _sql(FIX, body="""
SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS city, shapeID, shapeType AS gadm_level
FROM adm2_raw, (VALUES (1), (2)) t(copy) WHERE shapeName IS NOT NULL"""))
def k2_append_mode_guard(spark, d):
    from geoprep.sources.tables import read_back, write_table
    gadm2 = B.prepare_level(FX.adm2(spark, d), "ADM2")
    path = _scratch(spark, "gadm2")
    write_table(gadm2, path, mode="overwrite", partition_by=["country_code"])
    write_table(gadm2, path, mode="append", partition_by=["country_code"])
    try:
        write_table(gadm2, path, mode="upsert")
        raise AssertionError("an unknown mode must be refused")
    except ValueError:
        pass
    return read_back(spark, path, gadm2)


@register("k3_append_postal_partitioned", POSTAL_CTES + "SELECT * FROM postal")
def k3_append_postal_partitioned(spark, d):
    from geoprep.sources.tables import read_back, write_table
    from geoprep.spec import POSTAL_PARTITIONS
    out = _postal(spark, d)
    path = _scratch(spark, "postal")
    write_table(out, path, mode="append", partition_by=POSTAL_PARTITIONS, deal_by=POSTAL_PARTITIONS[:-1])
    return read_back(spark, path, out, partition_by=POSTAL_PARTITIONS)


@register("k4_csv_dump", ADM2_SQL)
def k4_csv_dump(spark, d):
    from geoprep.sources.tables import write_csv
    gadm2 = B.prepare_level(FX.adm2(spark, d), "ADM2")
    path = _scratch(spark, "gadm2-csv")
    write_csv(gadm2, path)
    return spark.read.schema(gadm2.schema).option("header", True).csv(path)


_UPSERT_SQL = """
WITH u AS (
  SELECT *, 0 AS batch FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT *, 1 AS batch FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                   ORDER BY batch DESC, o_orderdate DESC, o_orderkey DESC) AS rn FROM u)
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, o_orderstatus, o_totalprice FROM r WHERE rn = 1"""


def _upsert_inputs(spark, d):
    rows = FX.keyed_batch(spark, d)
    target = rows.where(F.expr("o_orderdate < TIMESTAMP_NTZ'1997-01-01 00:00:00'"))
    batch = rows.where(F.expr("o_orderdate >= TIMESTAMP_NTZ'1996-01-01 00:00:00'"))
    return target, batch


@register("k5_upsert_last_write_wins", _UPSERT_SQL)
def k5_upsert_last_write_wins(spark, d):
    from geoprep.operators.keyed import upsert
    target, batch = _upsert_inputs(spark, d)
    merged, _ = upsert(target, batch, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])
    return merged


_K6_SQL = POSTAL_CTES + """
SELECT country, state, city, postal_code, lat, lon, wkt_geometry FROM (
  SELECT *, row_number() OVER (PARTITION BY country, state, city, postal_code
                               ORDER BY wkt_geometry DESC, lat DESC, lon DESC) AS rn
  FROM postal WHERE country IS NOT NULL AND state IS NOT NULL AND city IS NOT NULL AND postal_code IS NOT NULL)
WHERE rn = 1"""


def _postal_keyed(spark, d):
    from geoprep.operators.keyed import upsert
    from geoprep.spec import POSTAL_COLUMNS, POSTAL_KEY
    out = _postal(spark, d)
    empty = out.limit(0)
    return upsert(empty, out, list(POSTAL_KEY), ["wkt_geometry", "lat", "lon"]), POSTAL_COLUMNS


@register("k6_upsert_postal_rejects", _K6_SQL)
def k6_upsert_postal_rejects(spark, d):
    (merged, _), cols = _postal_keyed(spark, d)
    return merged.select(*cols)


@register("k7_insert_if_absent", """
WITH q AS (SELECT 'E' || CAST(event_id AS VARCHAR) AS stock_id, event_type AS symbol, CAST(value AS FLOAT) AS price,
                  ts AS timestamp FROM events),
target AS (SELECT * FROM q WHERE timestamp < TIMESTAMP '2024-01-20'),
new AS (SELECT * FROM q WHERE timestamp >= TIMESTAMP '2024-01-15')
SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.symbol = n.symbol AND t.timestamp = n.timestamp)""")
def k7_insert_if_absent(spark, d):
    from geoprep.operators.keyed import insert_absent
    q = FX.quotes(spark, d)
    target = q.where(F.expr("timestamp < TIMESTAMP_NTZ'2024-01-20 00:00:00'"))
    new = q.where(F.expr("timestamp >= TIMESTAMP_NTZ'2024-01-15 00:00:00'"))
    return insert_absent(target, new, ["symbol", "timestamp"], ["stock_id"])


@register("k8_fixed_count_batches", """
SELECT o_orderkey, o_custkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1) / 5) AS BIGINT) AS batch_no
FROM orders""")
def k8_fixed_count_batches(spark, d):
    from geoprep.operators.keyed import batch_plan_rows
    from geoprep.spec import BATCH_ROWS
    plan = batch_plan_rows(FX.keyed_batch(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"], BATCH_ROWS)
    return plan.select("o_orderkey", "o_custkey", "batch_no")


_K9_SQL = _sql(FIX, O.polygon_ctes("lv", "adm1_raw"), body="""
, rows_ AS (
  SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS state, a.shapeID,
         CAST(coalesce(strlen(shapeGroup), 0) + coalesce(strlen(replace(shapeName, ' ', '_')), 0)
              + coalesce(strlen(a.shapeID), 0) + coalesce(strlen(shapeType), 0) + coalesce(strlen(w.wkt), 0)
              AS BIGINT) AS b
  FROM adm1_raw a LEFT JOIN lv_wkt w ON w.rid = a.shapeID WHERE shapeName IS NOT NULL),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY state, shapeID) AS seq FROM rows_),
greedy AS (
  SELECT country_code, seq, CAST(0 AS BIGINT) AS batch, b AS used, b FROM ordered WHERE seq = 1
  UNION ALL
  SELECT o.country_code, o.seq,
         CASE WHEN g.used + o.b > 1024 THEN g.batch + 1 ELSE g.batch END,
         CASE WHEN g.used + o.b > 1024 THEN o.b ELSE g.used + o.b END, o.b
  FROM greedy g JOIN ordered o ON o.country_code IS NOT DISTINCT FROM g.country_code AND o.seq = g.seq + 1)
SELECT country_code, batch AS batch_no, CAST(count(*) AS BIGINT) AS rows, CAST(sum(b) AS BIGINT) AS bytes
FROM greedy GROUP BY country_code, batch""")
# DuckDB needs the RECURSIVE keyword on the WITH clause
_K9_SQL = _K9_SQL.replace("WITH ", "WITH RECURSIVE ", 1).replace("\n\n, rows_ AS", ",\nrows_ AS")


@register("k9_byte_bounded_batches", _K9_SQL)
def k9_byte_bounded_batches(spark, d):
    """Greedy byte-bounded batches of the state table (1 KB limit), per country code."""
    from geoprep.operators.keyed import batch_plan_bytes, batch_summary
    gadm1 = B.prepare_level(FX.adm1(spark, d), "ADM1")
    plan = batch_plan_bytes(gadm1, ["country_code"], ["state", "shapeID"], max_bytes=1024)
    return batch_summary(plan, ["country_code"])


@register("k9b_hot_key_batches", """
WITH RECURSIVE r AS (
  SELECT lang, doc_id, 8 + coalesce(strlen(lang), 0) + coalesce(strlen(text), 0) AS b FROM documents),
o AS (SELECT lang, b, row_number() OVER w AS seq, sum(b) OVER w AS cum FROM r WINDOW w AS (PARTITION BY lang ORDER BY doc_id)),
n AS (SELECT a.lang, a.seq, CASE WHEN z.seq IS NOT NULL THEN greatest(a.seq + 1, z.seq) END AS nxt FROM o a
      ASOF LEFT JOIN o z ON a.lang = z.lang AND a.cum - a.b + 65536 < z.cum),
hop AS (SELECT lang, seq, nxt, CAST(0 AS BIGINT) AS batch_no FROM n WHERE seq = 1
        UNION ALL SELECT n.lang, n.seq, n.nxt, h.batch_no + 1 FROM hop h JOIN n ON n.lang = h.lang AND n.seq = h.nxt)
SELECT h.lang, h.batch_no, CAST(count(*) AS BIGINT) AS rows, CAST(sum(o.b) AS BIGINT) AS bytes
FROM hop h JOIN o ON o.lang = h.lang AND o.seq >= h.seq AND o.seq < coalesce(h.nxt, 9223372036854775807) GROUP BY ALL""")
def k9b_hot_key_batches(spark, d):
    """Byte-bounded batches (64 KB) of the documents of each language: few keys hold
    the whole table, and a batch depends on many segments of 64 rows before it."""
    from geoprep.operators.keyed import batch_plan_bytes, batch_summary
    rows = FX.read(spark, d, "documents").select("lang", "doc_id", "text")
    return batch_summary(batch_plan_bytes(rows, ["lang"], ["doc_id"], max_bytes=65536, segment_rows=64, fan=8), ["lang"])


@register("k8b_values_unchanged", """
SELECT o_orderpriority AS k, CASE WHEN o_orderkey % 3 > 0 THEN 9007199254740993 + o_orderkey END AS v,
       DATE '9999-12-31' AS until, CAST(floor((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) / 50) AS BIGINT) AS batch_no
FROM orders""")
def k8b_values_unchanged(spark, d):
    """Fixed-count batches over few large keys, with longs beyond 2^53 beside nulls and the
    last date: every value comes back as it was."""
    from geoprep.operators.keyed import batch_plan_rows
    rows = FX.read(spark, d, "orders").selectExpr("o_orderpriority AS k", "o_orderkey", "DATE'9999-12-31' AS until",
                                                  "CASE WHEN o_orderkey % 3 > 0 THEN 9007199254740993 + o_orderkey END AS v")
    return batch_plan_rows(rows, ["k"], ["o_orderkey"], 50).select("k", "v", "until", "batch_no")


@register("k10_parallel_write", ADM2_SQL)
def k10_parallel_write(spark, d):
    from geoprep.sources.tables import read_back, write_table
    gadm2 = B.prepare_level(FX.adm2(spark, d), "ADM2")
    path = _scratch(spark, "gadm2-par")
    write_table(gadm2, path, partitions=8)
    return read_back(spark, path, gadm2)


@register("k11_write_report", POSTAL_CTES + """
SELECT 'wof_data' AS "table",
       CASE WHEN country IS NULL OR state IS NULL OR city IS NULL OR postal_code IS NULL THEN 'rejected' ELSE 'written' END AS outcome,
       CASE WHEN country IS NULL THEN 'null key column country' WHEN state IS NULL THEN 'null key column state'
            WHEN city IS NULL THEN 'null key column city' WHEN postal_code IS NULL THEN 'null key column postal_code' END AS reason,
       CAST(count(*) AS BIGINT) AS rows
FROM postal GROUP BY ALL""")
def k11_write_report(spark, d):
    from geoprep.sources.tables import write_keyed
    from geoprep.spec import POSTAL_KEY
    return write_keyed(_postal(spark, d), _scratch(spark, "postal-keyed"), list(POSTAL_KEY), table="wof_data",
                       rejects_path=_scratch(spark, "postal-rejects"), partition_by=["country"])


@register("k11b_written_and_rejected", """
SELECT lang, CAST(c_acctbal AS DOUBLE) AS balance, outcome, reason FROM (
  SELECT CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS lang, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 5 = 0 THEN 'null key column lang' WHEN c_custkey % 3 = 0 THEN 'null key column balance' END AS reason,
         CASE WHEN c_custkey % 5 = 0 OR c_custkey % 3 = 0 THEN 'rejected' ELSE 'written' END AS outcome FROM customer)""")
def k11b_written_and_rejected(spark, d):
    """Both tables of a keyed write as they stand on disk: accepted rows, and rejects with their reason."""
    from geoprep.sources.tables import write_keyed
    rows = FX.read(spark, d, "customer").selectExpr("CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS lang",
                                                    "CAST(CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS DOUBLE) AS balance")
    path, bad = _scratch(spark, "keyed-table"), _scratch(spark, "keyed-rejects")
    write_keyed(rows, path, ["lang", "balance"], table="balances", rejects_path=bad, partition_by=["lang"])
    return spark.read.parquet(path).select("lang", "balance", F.lit("written").alias("outcome"), F.lit(None).cast("string").alias("reason")) \
        .unionByName(spark.read.parquet(bad).select("lang", "balance", F.lit("rejected").alias("outcome"), F.col("reject_reason").alias("reason")))


@register("k12_align_to_table", _sql(FIX, body="""
SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS city, shapeID, shapeType AS gadm_level,
       CAST(NULL AS VARCHAR) AS wkt_geometry_city
FROM adm2_raw WHERE shapeName IS NOT NULL"""))
def k12_align_to_table(spark, d):
    from geoprep.operators.keyed import align
    gadm2 = B.prepare_level(FX.adm2(spark, d), "ADM2")
    return align(gadm2, "country_code string, city string, shapeID string, gadm_level string, wkt_geometry_city string")


@register("k13_level_dispatch", _sql(FIX, body="""
SELECT 'gadm0_data' AS "table", CAST(count(*) AS BIGINT) AS rows FROM adm0_raw
UNION ALL SELECT 'gadm1_data', CAST(count(*) AS BIGINT) FROM adm1_raw WHERE shapeName IS NOT NULL
UNION ALL SELECT 'gadm2_data', CAST(count(*) AS BIGINT) FROM adm2_raw WHERE shapeName IS NOT NULL"""))
def k13_level_dispatch(spark, d):
    from geoprep.spec import LEVELS
    raw = FX.boundaries(spark, d)
    parts = [B.prepare_level(raw[lvl], spec).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(spec.table).alias("table"), "rows") for lvl, spec in LEVELS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("k14_skip_empty_write", _sql(FIX, body="""
SELECT 'empty' AS frame, false AS written, CAST(0 AS BIGINT) AS rows
UNION ALL SELECT 'gadm0', true, CAST(count(*) AS BIGINT) FROM adm0_raw"""))
def k14_skip_empty_write(spark, d):
    from geoprep.sources.tables import path_exists, write_table
    gadm0 = B.prepare_level(FX.adm0(spark, d), "ADM0")
    empty_path, full_path = _scratch(spark, "empty"), _scratch(spark, "gadm0")
    w_empty = write_table(gadm0.where(F.col("country_code") == "ZZ"), empty_path, skip_empty=True)
    w_full = write_table(gadm0, full_path, skip_empty=True)
    assert not path_exists(spark, empty_path)
    written = spark.read.parquet(full_path)
    return (spark.range(1).select(F.lit("empty").alias("frame"), F.lit(w_empty).alias("written"),
                                  F.lit(0).cast("long").alias("rows"))
            .unionByName(written.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit("gadm0").alias("frame"), F.lit(w_full).alias("written"), "rows")))


@register("k15_clustering_order", """
SELECT event_type AS symbol, ts AS timestamp,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS BIGINT) AS pos FROM events""")
def k15_clustering_order(spark, d):
    from geoprep.operators.keyed import cluster_order
    laid = cluster_order(FX.quotes(spark, d), "symbol", "timestamp")
    # where the layout put a row, without sorting again: its place in its partition after the
    # symbol's first row there, plus the symbol's rows in earlier partitions
    from geoprep.operators.stage import stage_table
    placed = stage_table(laid.select("symbol", "timestamp", F.spark_partition_id().alias("part"),
                                     F.monotonically_increasing_id().alias("place")), "k15-layout")
    runs = placed.groupBy("symbol", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("symbol").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))     # one row a symbol and partition
    return placed.join(runs, ["symbol", "part"]).select(
        "symbol", "timestamp", (F.col("place") - F.col("first") + 1 + F.col("before")).alias("pos"))


# =======================================================================================
# §2.3 projections

@register("p1_rename_adm0", _sql(FIX, body="""
SELECT shapeGroup AS country_code, shapeType AS gadm_level, shapeName AS country_full_name, shapeID FROM adm0_raw"""))
def p1_rename_adm0(spark, d):
    from geoprep.spec import LEVELS
    return FX.adm0(spark, d).drop("geometry").withColumnsRenamed(LEVELS["ADM0"].rename)


@register("p1b_rename_combined_adm0", _sql(FIX, O.polygon_ctes("w0", "adm0_raw"), body=f"""
SELECT {ADM0_MAP_SQL.format(c='shapeGroup')} AS country, shapeType, replace(shapeName, ' ', '_') AS country_full_name,
       shapeID, w.wkt AS wkt_geometry_country, 'ADM0' AS gadm_level
FROM adm0_raw a LEFT JOIN w0_wkt w ON w.rid = a.shapeID"""))
def p1b_rename_combined_adm0(spark, d):
    from geoprep.spec import COMBINED_LEVELS
    return B.prepare_level(FX.adm0(spark, d), COMBINED_LEVELS["ADM0"])


@register("p2_select_level_columns", ADM2_SQL)
def p2_select_level_columns(spark, d):
    return B.prepare_level(FX.adm2(spark, d), "ADM2")


@register("p3_select_postal_columns", POSTAL_CTES + "SELECT country, state, city, postal_code, lat, lon, wkt_geometry FROM postal")
def p3_select_postal_columns(spark, d):
    from geoprep.spec import POSTAL_COLUMNS
    return _postal(spark, d).select(*POSTAL_COLUMNS)


@register("p4_literal_level", _sql(FIX, O.polygon_ctes("w2", "adm2_raw"), body="""
SELECT shapeGroup, shapeType, replace(shapeName, ' ', '_') AS city, shapeID, w.wkt AS wkt_geometry_city,
       'ADM2' AS gadm_level
FROM adm2_raw a LEFT JOIN w2_wkt w ON w.rid = a.shapeID"""))
def p4_literal_level(spark, d):
    from geoprep.spec import COMBINED_LEVELS
    return B.prepare_level(FX.adm2(spark, d), COMBINED_LEVELS["ADM2"])


@register("p5_drop_columns", _sql(FIX, PLACES, body="SELECT id, country, postal_code, city, lat, lon FROM places"))
def p5_drop_columns(spark, d):
    return _places(spark, d).drop("geometry")


@register("p6_lazy_scan_projection", _sql(FIX, body="""
SELECT shapeGroup AS country_code FROM adm1_raw WHERE shapeName IS NOT NULL"""))
def p6_lazy_scan_projection(spark, d):
    """Select on a lazy scan of a written, partitioned table: only the partition column is
    read (ReadSchema is empty; the values come from the directory names)."""
    from geoprep.sources.tables import read_table, write_table
    gadm1 = B.prepare_level(FX.adm1(spark, d), "ADM1")
    path = _scratch(spark, "gadm1-lazy")
    write_table(gadm1, path, partition_by=["country_code"])
    return read_table(spark, path, columns=["country_code"], schema=gadm1.schema)


@register("p7_aliased_sql_projection", _sql(FIX, body="""
SELECT spr.id, spr.country, spr.name AS postal_code, geo.body AS geojson_data
FROM spr JOIN geojson AS geo ON spr.id = geo.id WHERE spr.country IN ('USA', 'US')"""))
def p7_aliased_sql_projection(spark, d):
    FX.spr(spark, d).createOrReplaceTempView("spr")
    FX.geojson(spark, d).createOrReplaceTempView("geojson")
    return spark.sql("""SELECT spr.id, spr.country, spr.name AS postal_code, geo.body AS geojson_data
                        FROM spr AS spr JOIN geojson AS geo ON spr.id = geo.id
                        WHERE spr.country IN ('USA', 'US')""")


@register("p8_with_columns", _sql(FIX, PLACES, body="SELECT id, wkt AS wkt_geometry, city, lat, lon FROM places"))
def p8_with_columns(spark, d):
    return _places(spark, d).select("id", G.to_wkt("geometry").alias("wkt_geometry"), "city", "lat", "lon")


# =======================================================================================
# §2.4 filters

@register("f1_drop_null_country", _sql(FIX, O.polygon_ctes("lv", "adm1_raw"), body="""
SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS state, a.shapeID, shapeType AS gadm_level,
       w.wkt AS wkt_geometry_state
FROM adm1_raw a LEFT JOIN lv_wkt w ON w.rid = a.shapeID WHERE shapeName IS NOT NULL AND shapeGroup IS NOT NULL"""))
def f1_drop_null_country(spark, d):
    return B.prepare_level(FX.adm1(spark, d), "ADM1", drop_null_country=True)


@register("f2_name_not_null", ADM1_SQL)
def f2_name_not_null(spark, d):
    return B.prepare_level(FX.adm1(spark, d), "ADM1")


@register("f3_country_in", _sql(FIX, body="SELECT id, country, name FROM spr WHERE country IN ('USA', 'US')"))
def f3_country_in(spark, d):
    from geoprep.spec import POSTAL_COUNTRIES
    return FX.spr(spark, d).where(F.col("country").isin(*POSTAL_COUNTRIES))


_CODES = tuple(f"{i:05d}" for i in range(100, 137))


@register("f4_postal_code_list", _sql(FIX, body=f"""
SELECT id, country, name FROM spr WHERE country = 'USA' AND name IN ({", ".join(f"'{c}'" for c in _CODES)})"""))
def f4_postal_code_list(spark, d):
    from geoprep.operators.filters import filter_values
    return filter_values(FX.spr(spark, d).where(F.col("country") == "USA"), "name", _CODES)


@register("f5_partition_filter_count", _sql(FIX, body="SELECT CAST(count(*) AS BIGINT) AS n FROM spr WHERE country = 'US'"))
def f5_partition_filter_count(spark, d):
    from geoprep.operators.profile import row_count
    from geoprep.sources.tables import read_table, write_table
    path = _scratch(spark, "spr")
    write_table(FX.spr(spark, d), path, partition_by=["country"])
    return row_count(read_table(spark, path, where=F.col("country") == "US"))


@register("f6_drop_null_island", _sql(FIX, PLACES, body="""
SELECT id, wkt AS wkt_geometry FROM places WHERE wkt IS DISTINCT FROM 'POINT (0 0)'"""))
def f6_drop_null_island(spark, d):
    return P.drop_null_island(_places(spark, d)).select("id", G.to_wkt("geometry").alias("wkt_geometry"))


@register("f7_mismatch_report", POSTAL_CTES + "SELECT country, state, city, postal_code FROM postal WHERE state IS NULL OR city IS NULL")
def f7_mismatch_report(spark, d):
    return P.mismatches(_postal(spark, d))


@register("f8_empty_input", _sql(FIX, O.polygon_ctes("lv", "adm1_raw"), body="""
SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS state, a.shapeID, shapeType AS gadm_level,
       w.wkt AS wkt_geometry_state
FROM adm1_raw a LEFT JOIN lv_wkt w ON w.rid = a.shapeID WHERE shapeName IS NOT NULL AND a.shapeGroup = 'NONE'"""))
def f8_empty_input(spark, d):
    return B.prepare_level(FX.adm1(spark, d).where(F.col("shapeGroup") == "NONE"), "ADM1")


@register("f9_hierarchy_lookup", _sql(FIX, body="""
SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS city, shapeID, shapeType AS gadm_level
FROM adm2_raw WHERE shapeName IS NOT NULL AND shapeGroup = 'USA' AND replace(shapeName, ' ', '_') = 'City_5'"""))
def f9_hierarchy_lookup(spark, d):
    from geoprep.operators.profile import lookup
    from geoprep.sources.tables import read_back, write_table
    gadm2 = B.prepare_level(FX.adm2(spark, d), "ADM2")
    path = _scratch(spark, "gadm2-lookup")
    write_table(gadm2, path, partition_by=["country_code", "city"])
    return lookup(read_back(spark, path, gadm2), "USA", city="City_5", country_col="country_code")


# =======================================================================================
# §2.5 joins

@register("j1_record_body_join", _sql(FIX, body="""
SELECT s.id, s.country, s.name AS postal_code, g.body AS geojson_data
FROM spr s JOIN geojson g ON s.id = g.id WHERE s.country IN ('USA', 'US')"""))
def j1_record_body_join(spark, d):
    return P.gazetteer_records(FX.spr(spark, d), FX.geojson(spark, d))


@register("j4_merge_city_on_geometry", lambda: O.with_ctes(
    FIX, O.polygon_ctes("ct", "adm2_raw"), PLACES, O.hits_cte("ct_hits", "ct")) + """,
pick AS (
  SELECT wkt, city FROM (
    SELECT h.wkt, a.shapeName AS city,
           row_number() OVER (PARTITION BY h.wkt ORDER BY a.shapeName IS NULL, a.shapeName, a.shapeID) AS rn
    FROM ct_hits h JOIN adm2_raw a ON a.shapeID = h.rid) WHERE rn = 1)
SELECT p.id, p.city AS city_x, k.city AS city_y FROM places p LEFT JOIN pick k ON k.wkt = p.wkt""")
def j4_merge_city_on_geometry(spark, d):
    from geoprep.operators import spatial as S
    places = _places(spark, d)
    best = S.first_match_table(places, P.city_polygons(FX.adm2(spark, d)),
                               [F.isnull("__gadm_city"), F.col("__gadm_city"), F.col("__city_id")])
    out = S.join_matches(S.with_match_keys(places), best)
    return out.select("id", F.col("city").alias("city_x"), F.col("__gadm_city").alias("city_y"))


# =======================================================================================
# §2.6 aggregation and distinct

@register("a1_count_records", _sql(FIX, body="SELECT CAST(count(*) AS BIGINT) AS n FROM spr"))
def a1_count_records(spark, d):
    from geoprep.operators.profile import row_count
    return row_count(FX.spr(spark, d))


@register("a2_distinct_country", _sql(FIX, body="SELECT DISTINCT country FROM spr"))
def a2_distinct_country(spark, d):
    from geoprep.operators.profile import distinct_values
    return distinct_values(FX.spr(spark, d), "country")


@register("a3_filtered_count", "SELECT CAST(count(*) AS BIGINT) AS n FROM orders WHERE year(o_orderdate) = 1998")
def a3_filtered_count(spark, d):
    from geoprep.operators.profile import row_count
    return row_count(FX.read(spark, d, "orders").where(F.year("o_orderdate") == 1998))


@register("a5_level_dedupe", _combined_sql())
def a5_level_dedupe(spark, d):
    return B.combine_levels(FX.boundaries(spark, d))


@register("a6_distinct_names", _sql(FIX, body="""
SELECT DISTINCT replace(shapeName, ' ', '_') AS state FROM adm1_raw WHERE shapeName IS NOT NULL"""))
def a6_distinct_names(spark, d):
    from geoprep.operators.profile import distinct_values
    return distinct_values(B.prepare_level(FX.adm1(spark, d), "ADM1"), "state")


@register("a7_load_profile", _sql(FIX, O.polygon_ctes("lv", "adm1_raw"), body="""
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(coalesce(strlen(shapeGroup), 0) + coalesce(strlen(replace(shapeName, ' ', '_')), 0)
                + coalesce(strlen(a.shapeID), 0) + coalesce(strlen(shapeType), 0)
                + coalesce(strlen(w.wkt), 0)) AS BIGINT) AS bytes
FROM adm1_raw a LEFT JOIN lv_wkt w ON w.rid = a.shapeID WHERE shapeName IS NOT NULL"""))
def a7_load_profile(spark, d):
    from geoprep.operators.profile import profile
    gadm1 = B.prepare_level(FX.adm1(spark, d), "ADM1")
    observed, obs = profile(gadm1)
    path = _scratch(spark, "gadm1-profiled")
    observed.write.mode("overwrite").parquet(path)
    m = obs.get
    return spark.range(1).select(F.lit(int(m["rows"])).cast("long").alias("rows"),
                                 F.lit(int(m["bytes"])).cast("long").alias("bytes"))


@register("a8_chunk_count", _sql(FIX, body="""
SELECT CAST(floor(count(*) / 100000) + 1 AS BIGINT) AS chunks FROM spr"""))
def a8_chunk_count(spark, d):
    from geoprep.operators.profile import chunk_count
    from geoprep.spec import POSTAL_CHUNK_ROWS
    return FX.spr(spark, d).agg(chunk_count(F.count(F.lit(1)), POSTAL_CHUNK_ROWS).alias("chunks"))


# =======================================================================================
# §2.8 sort, limit, union

@register("o1_sort_level_desc", _combined_sql().replace(
    "FROM ranked WHERE rn = 1", "FROM ranked WHERE rn = 1 ORDER BY gadm_level DESC"))
def o1_sort_level_desc(spark, d):
    return B.combine_levels(FX.boundaries(spark, d)).orderBy(F.col("gadm_level").desc())


@register("o2_preview", _sql(FIX, body="SELECT id, country, name FROM spr ORDER BY id LIMIT 5"))
def o2_preview(spark, d):
    from geoprep.operators.profile import preview
    return preview(FX.spr(spark, d).orderBy("id"), 5)


@register("o3_page", _sql(FIX, body="""
SELECT s.id, s.country, s.name AS postal_code, g.body AS geojson_data
FROM spr s JOIN geojson g ON s.id = g.id WHERE s.country IN ('USA', 'US') ORDER BY s.id LIMIT 100 OFFSET 200"""))
def o3_page(spark, d):
    from geoprep.operators.profile import page
    return page(P.gazetteer_records(FX.spr(spark, d), FX.geojson(spark, d)), "id", 200, 100)


@register("u1_union_by_name", _sql(FIX, O.polygon_ctes("w0", "adm0_raw"), O.polygon_ctes("w1", "adm1_raw"),
                                   O.polygon_ctes("w2", "adm2_raw"), body="""
SELECT shapeGroup, shapeType, replace(shapeName, ' ', '_') AS city, shapeID, w.wkt AS wkt_geometry_city,
       'ADM2' AS gadm_level, NULL AS state, NULL AS wkt_geometry_state, NULL AS country,
       NULL AS country_full_name, NULL AS wkt_geometry_country
FROM adm2_raw a LEFT JOIN w2_wkt w ON w.rid = a.shapeID
UNION ALL
SELECT shapeGroup, shapeType, NULL, shapeID, NULL, 'ADM1', replace(shapeName, ' ', '_'), w.wkt, NULL, NULL, NULL
FROM adm1_raw a LEFT JOIN w1_wkt w ON w.rid = a.shapeID
UNION ALL
SELECT NULL, shapeType, NULL, shapeID, NULL, 'ADM0', NULL, NULL, """ + ADM0_MAP_SQL.format(c="shapeGroup") + """,
       replace(shapeName, ' ', '_'), w.wkt
FROM adm0_raw a LEFT JOIN w0_wkt w ON w.rid = a.shapeID"""))
def u1_union_by_name(spark, d):
    from geoprep.spec import COMBINED_LEVELS
    raw = FX.boundaries(spark, d)
    return B.union_levels([B.prepare_level(raw[lvl], COMBINED_LEVELS[lvl]) for lvl in ("ADM2", "ADM1", "ADM0")])


# =======================================================================================
# §2.9 scalar functions

@register("x1_country_code_map", ADM0_SQL)
def x1_country_code_map(spark, d):
    return B.prepare_level(FX.adm0(spark, d), "ADM0")


@register("x2_spaces_to_underscores", _sql(FIX, body="""
SELECT shapeID, replace(shapeName, ' ', '_') AS name FROM adm1_raw"""))
def x2_spaces_to_underscores(spark, d):
    from geoprep.functions.text import underscore
    return FX.adm1(spark, d).select("shapeID", underscore("shapeName").alias("name"))


@register("x3_fill_city", POSTAL_CTES + "SELECT postal_code, wkt_geometry, city FROM postal")
def x3_fill_city(spark, d):
    return _postal(spark, d).select("postal_code", "wkt_geometry", "city")


@register("x4_missing_to_nan", _sql(FIX, PLACES, body="SELECT id, lat, lon FROM places"))
def x4_missing_to_nan(spark, d):
    return _places(spark, d).select("id", "lat", "lon")


@register("x5_cast_double", _sql(FIX, body="""
SELECT id, CAST(json_extract_string(body, '$.properties."geom:latitude"') AS DOUBLE) AS lat
FROM geojson WHERE json_valid(body) AND json_extract_string(body, '$.properties."geom:latitude"') IS NOT NULL"""))
def x5_cast_double(spark, d):
    lat = F.from_json(F.col("body"), "properties map<string,string>")["properties"].getItem("geom:latitude")
    g = FX.geojson(spark, d).select("id", lat.alias("t")).where(F.col("t").isNotNull())
    return g.select("id", F.col("t").try_cast("double").alias("lat"))


@register("x6_json_properties", _sql(FIX, body="""
SELECT id, json_extract_string(body, '$.properties."mz:postal_locality"') AS locality,
       json_extract_string(body, '$.properties."geom:longitude"') AS lon_text
FROM geojson WHERE json_valid(body)"""))
def x6_json_properties(spark, d):
    props = F.from_json(F.col("body"), "properties map<string,string>")["properties"]
    g = FX.geojson(spark, d)
    return g.where(F.expr("try_parse_json(body)").isNotNull()).select(
        "id", props.getItem("mz:postal_locality").alias("locality"), props.getItem("geom:longitude").alias("lon_text"))


@register("x7_geojson_geometry", _sql(FIX, PLACES, body="SELECT id, wkt AS wkt_geometry FROM places"))
def x7_geojson_geometry(spark, d):
    return _places(spark, d).select("id", G.to_wkt("geometry").alias("wkt_geometry"))


_COLLECTIONS = """, coll AS (
  SELECT id, lon AS x, lat AS y FROM place_base WHERE id % 5 = 0)"""


@register("x7b_geometry_collection", _sql(FIX, body=_COLLECTIONS + """
SELECT id, 'GEOMETRYCOLLECTION (POINT (' || {x} || ' ' || {y} || '), LINESTRING (' || {x4} || ' ' || {y} || ', ' || {x45} || ' ' || {y25}
       || '), POLYGON ((' || {x} || ' ' || {y4} || ', ' || {x5} || ' ' || {y4} || ', ' || {x5} || ' ' || {y45} || ', ' || {x} || ' ' || {y45}
       || ', ' || {x} || ' ' || {y4} || ')))' AS wkt_geometry, 'Town ' || CAST(id % 9 AS VARCHAR) AS city, y AS lat, x AS lon FROM coll""".format(
    **{k: O.fmt(v) for k, v in {"x": "x", "y": "y", "x4": "(x + 4)", "x45": "(x + 4.5)", "x5": "(x + 0.5)", "y25": "(y + 0.25)",
                                "y4": "(y + 4)", "y45": "(y + 4.5)"}.items()})))
def x7b_geometry_collection(spark, d):
    """Bodies that hold a collection, half of them with a collection inside it: geometry, city
    and coordinates are kept (X7)."""
    out = P.parse_records(FX.collections(spark, d))
    return out.select("id", G.to_wkt("geometry").alias("wkt_geometry"), "city", "lat", "lon")


@register("x8_geometry_wkt", lambda: _sql(FIX, O.polygon_ctes("w1", "adm1_raw"), body="""
SELECT a.shapeID, w.wkt AS wkt FROM adm1_raw a LEFT JOIN w1_wkt w ON w.rid = a.shapeID"""))
def x8_geometry_wkt(spark, d):
    return FX.adm1(spark, d).select("shapeID", G.to_wkt("geometry").alias("wkt"))


@register("x9_uuid", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS valid FROM events")
def x9_uuid(spark, d):
    q = FX.quotes(spark, d).withColumn("stock_id", F.expr("uuid()"))
    pattern = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return q.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("stock_id").rlike(pattern), 1)).alias("valid"))


@register("x10_current_timestamp", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS stamped FROM events")
def x10_current_timestamp(spark, d):
    q = FX.quotes(spark, d).withColumn("written_at", F.current_timestamp())
    return q.agg(F.count(F.lit(1)).alias("n"), F.count("written_at").alias("stamped"))


@register("x11_point_lon_lat", _sql(FIX, PLACES, body="SELECT id, px AS x, py AS y FROM places WHERE px IS NOT NULL"))
def x11_point_lon_lat(spark, d):
    g = F.col("geometry")
    return _places(spark, d).where(g["kind"] == G.POINT).select("id", G.point_x(g).alias("x"), G.point_y(g).alias("y"))


@register("x12_reproject", _sql(FIX, PLACES, body="""
SELECT id, round(px * 6378137.0 * pi() / 180.0, 3) + 0.0 AS mx,
       CASE WHEN abs(py) <= 90 THEN round(ln(tan(pi() / 4 + py * pi() / 360.0)) * 6378137.0, 3) + 0.0 END AS my,
       round(px, 6) + 0.0 AS bx, CASE WHEN abs(py) <= 90 THEN round(py, 6) + 0.0 END AS by
FROM places WHERE px IS NOT NULL"""))
def x12_reproject(spark, d):
    g = F.col("geometry")
    pts = _places(spark, d).where(g["kind"] == G.POINT)
    m = G.to_crs(g, G.WGS84, G.WEB_MERCATOR)
    back = G.to_crs(m, G.WEB_MERCATOR, G.WGS84)
    z = F.lit(0.0)   # +0.0 turns a rounded -0.0 into 0.0
    return pts.select("id", (F.round(G.point_x(m), 3) + z).alias("mx"), (F.round(G.point_y(m), 3) + z).alias("my"),
                      (F.round(G.point_x(back), 6) + z).alias("bx"), (F.round(G.point_y(back), 6) + z).alias("by"))


@register("x13_malformed_json", _sql(FIX, PLACES, body="""
SELECT id, wkt IS NULL AS failed, city, lat, lon FROM places WHERE id IN (SELECT id FROM geojson WHERE NOT json_valid(body))"""))
def x13_malformed_json(spark, d):
    pl = _places(spark, d)
    bad = FX.geojson(spark, d).where(F.expr("try_parse_json(body)").isNull())
    return pl.join(bad.select("id"), "id", "left_semi").select(
        "id", F.col("geometry").isNull().alias("failed"), "city", "lat", "lon")


# =======================================================================================
# §2.10 incremental load

def _records_dir(spark, d):
    from geoprep.streaming.incremental import stage_records
    return stage_records(P.gazetteer_records(FX.spr(spark, d), FX.geojson(spark, d)), _scratch(spark, "records"),
                         chunk_rows=300)


def _incremental(spark, target):
    from geoprep.sources.tables import read_back
    from geoprep.spec import POSTAL_PARTITIONS, POSTAL_SCHEMA
    return read_back(spark, target, spark.createDataFrame([], POSTAL_SCHEMA), partition_by=POSTAL_PARTITIONS)


@register("t1_chunked_incremental_load", POSTAL_CTES + "SELECT * FROM postal")
def t1_chunked_incremental_load(spark, d):
    from geoprep.streaming.incremental import chunked_load
    target = _scratch(spark, "postal-incremental")
    chunked_load(spark, _records_dir(spark, d), FX.adm1(spark, d), FX.adm2(spark, d), target, files_per_chunk=1)
    return _incremental(spark, target)


@register("t1b_two_loads", POSTAL_CTES + "SELECT * FROM postal")
def t1b_two_loads(spark, d):
    """Two halves of the records loaded one after the other into one table."""
    from geoprep.streaming.incremental import chunked_load, stage_records
    target = _scratch(spark, "postal-two-loads")
    recs = P.gazetteer_records(FX.spr(spark, d), FX.geojson(spark, d))
    odd = F.pmod(F.xxhash64("id"), F.lit(2)) == 1
    for half in (recs.where(odd), recs.where(~odd)):
        chunked_load(spark, stage_records(half, _scratch(spark, "records"), 1000), FX.adm1(spark, d), FX.adm2(spark, d), target)
    return _incremental(spark, target)


@register("t2b_limit_then_resume", POSTAL_CTES + "SELECT * FROM postal")
def t2b_limit_then_resume(spark, d):
    """One chunk, then the rest of the same load."""
    from geoprep.streaming.incremental import chunked_load
    target, recs = _scratch(spark, "postal-resumed"), _records_dir(spark, d)
    for limit in (1, None):
        chunked_load(spark, recs, FX.adm1(spark, d), FX.adm2(spark, d), target, max_chunks=limit)
    return _incremental(spark, target)


_FIRST_CHUNK_SQL = POSTAL_CTES.replace(
    "WHERE s.country IN ('USA', 'US')),",
    "WHERE s.country IN ('USA', 'US') ORDER BY s.id LIMIT 500),") + "SELECT * FROM postal"


@register("t2_test_mode_first_chunk", _FIRST_CHUNK_SQL)
def t2_test_mode_first_chunk(spark, d):
    from geoprep.streaming.incremental import first_chunk
    rec = first_chunk(P.gazetteer_records(FX.spr(spark, d), FX.geojson(spark, d)), 500)
    return P.enrich_records(rec, FX.adm1(spark, d), FX.adm2(spark, d))


@register("t3_stop_when_exhausted", POSTAL_CTES + "SELECT CAST(count(*) AS BIGINT) AS rows_appended FROM postal")
def t3_stop_when_exhausted(spark, d):
    from geoprep.streaming.incremental import chunked_load
    target = _scratch(spark, "postal-incremental")
    stats = chunked_load(spark, _records_dir(spark, d), FX.adm1(spark, d), FX.adm2(spark, d), target,
                         files_per_chunk=2)
    return _incremental(spark, target).agg(F.count(F.lit(1)).alias("rows_appended")).where(
        F.lit(stats["chunks"]) > 0)


# =======================================================================================
# §2.11 cache

def _cached_adm1(spark, d, ttl, action):
    from geoprep.operators.cache import FrameCache
    cache = FrameCache(ttl_minutes=ttl)
    key = f"gadm_{d}/supplier.parquet"
    loader = lambda: B.prepare_level(FX.adm1(spark, d), "ADM1")
    df = cache.set(key, loader())
    if action == "get":
        got = cache.get(key)
        return got if got is not None else cache.get_or_load(key, loader)
    if action == "invalidate":
        cache.invalidate(key)
        assert key not in cache
        return cache.get_or_load(key, loader)
    if action == "clear":
        cache.clear()
        assert len(cache) == 0
        return cache.get_or_load(key, loader)
    return df


@register("c1_cache_set", ADM1_SQL)
def c1_cache_set(spark, d):
    return _cached_adm1(spark, d, 15, "set")


@register("c2_cache_get_ttl", ADM1_SQL)
def c2_cache_get_ttl(spark, d):
    return _cached_adm1(spark, d, 0, "get")


@register("c3_cache_invalidate", ADM1_SQL)
def c3_cache_invalidate(spark, d):
    return _cached_adm1(spark, d, 15, "invalidate")


@register("c4_cache_clear", ADM1_SQL)
def c4_cache_clear(spark, d):
    return _cached_adm1(spark, d, 15, "clear")


# =======================================================================================
# §2.12 jobs

@register("w2_all_levels", _sql(FIX, body="""
SELECT 'ADM0' AS level, 'gadm0_data' AS "table", CAST(count(*) AS BIGINT) AS rows FROM adm0_raw
UNION ALL SELECT 'ADM1', 'gadm1_data', CAST(count(*) AS BIGINT) FROM adm1_raw WHERE shapeName IS NOT NULL
UNION ALL SELECT 'ADM2', 'gadm2_data', CAST(count(*) AS BIGINT) FROM adm2_raw WHERE shapeName IS NOT NULL"""))
def w2_all_levels(spark, d):
    from geoprep.plans.jobs import run_all_levels
    out = _scratch(spark, "boundaries")
    reports = run_all_levels(spark, FX.boundaries(spark, d), out)
    tables = [spark.read.parquet(r["path"]).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(r["level"]).alias("level"), F.lit(r["table"]).alias("table"), "rows") for r in reports]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@register("w3_combined_hierarchy", _combined_sql())
def w3_combined_hierarchy(spark, d):
    return B.combine_levels(FX.boundaries(spark, d))


@register("w5_serve_postal", _K6_SQL)
def w5_serve_postal(spark, d):
    from geoprep.plans.jobs import serve_postal
    from geoprep.spec import POSTAL_COLUMNS
    src = _scratch(spark, "postal-parquet")
    _postal(spark, d).write.mode("overwrite").parquet(src)
    table, _ = serve_postal(spark, src)
    return table.select(*POSTAL_COLUMNS)


@register("w5b_serve_twice", POSTAL_CTES + """
, served AS (SELECT *, 1 AS b FROM postal WHERE CAST(postal_code AS INTEGER) % 3 > 0
             UNION ALL SELECT *, 2 AS b FROM postal WHERE CAST(postal_code AS INTEGER) % 2 = 0)
SELECT country, state, city, postal_code, lat, lon, wkt_geometry FROM (
  SELECT *, row_number() OVER (PARTITION BY country, state, city, postal_code ORDER BY b DESC, wkt_geometry DESC, lat DESC, lon DESC) AS rn
  FROM served WHERE country IS NOT NULL AND state IS NOT NULL AND city IS NOT NULL AND postal_code IS NOT NULL) WHERE rn = 1""")
def w5b_serve_twice(spark, d):
    """Two overlapping batches served one after the other into the stored table, the second one
    twice: it ends as after one pass of each."""
    from geoprep.plans.jobs import store_postal
    from geoprep.sources.tables import read_stored
    from geoprep.spec import POSTAL_COLUMNS
    postal, out = _postal(spark, d), _scratch(spark, "served")
    code = F.col("postal_code").cast("int")
    for name, part in (("a", code % 3 > 0), ("b", code % 2 == 0), ("b", None)):
        src = f"{out}-{name}"
        if part is not None:
            postal.where(part).write.mode("overwrite").parquet(src)
        store_postal(spark, src, out)
    return read_stored(spark, f"{out}/wof_data", postal, ["country"]).select(*POSTAL_COLUMNS)


@register("w1_store_state_table", _sql(FIX, body="""
SELECT country_code, state, shapeID, gadm_level FROM (
  SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS state, a.shapeID, shapeType AS gadm_level,
         row_number() OVER (PARTITION BY shapeGroup, replace(shapeName, ' ', '_') ORDER BY a.shapeID DESC) AS rn
  FROM adm1_raw a WHERE shapeName IS NOT NULL AND shapeGroup IS NOT NULL) WHERE rn = 1"""))
def w1_store_state_table(spark, d):
    """The whole of the boundary job for the states (W1): prepared, written, and its rows
    upserted into the keyed state table, twice."""
    from geoprep.plans.jobs import run_level
    from geoprep.sources.tables import read_stored
    out, store = _scratch(spark, "boundaries"), _scratch(spark, "stored")
    for _ in range(2):
        rep = run_level(spark, FX.adm1(spark, d), "ADM1", out, store_root=store)
    like = spark.createDataFrame([], "country_code string")
    return read_stored(spark, rep["stored"], like, ["country_code"]).select("country_code", "state", "shapeID", "gadm_level")


@register("w6_parallel_jobs", POSTAL_CTES + """
SELECT 'postal' AS product, CAST(count(*) AS BIGINT) AS rows FROM postal
UNION ALL SELECT 'boundaries', CAST(count(*) AS BIGINT) FROM adm1_raw WHERE shapeName IS NOT NULL""")
def w6_parallel_jobs(spark, d):
    from geoprep.plans.jobs import run_parallel
    post, bnd = _scratch(spark, "postal-out"), _scratch(spark, "gadm1-out")
    run_parallel({
        "postal": lambda: _postal(spark, d).write.mode("overwrite").parquet(post),
        "boundaries": lambda: B.prepare_level(FX.adm1(spark, d), "ADM1").write.mode("overwrite").parquet(bnd),
    })
    a = spark.read.parquet(post).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("postal").alias("product"), "rows")
    b = spark.read.parquet(bnd).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("boundaries").alias("product"), "rows")
    return a.unionByName(b)


# =======================================================================================
# §8 variants

@register("q3_dev_level_spec", _sql(FIX, O.polygon_ctes("w2", "adm2_raw"), body="""
SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS city, shapeID, shapeType AS gadm_level,
       w.wkt AS wkt_geometry_city
FROM adm2_raw a LEFT JOIN w2_wkt w ON w.rid = a.shapeID"""))
def q3_dev_level_spec(spark, d):
    """Development variant: keeps the level's WKT column and has no name filter (Q3)."""
    from geoprep.spec import DEV_LEVELS
    return B.prepare_level(FX.adm2(spark, d), DEV_LEVELS["ADM2"])


@register("q2_country_map_all_levels", _sql(FIX, O.polygon_ctes("lv", "adm1_raw"), body=f"""
SELECT {ADM0_MAP_SQL.format(c='shapeGroup')} AS country_code, replace(shapeName, ' ', '_') AS state, a.shapeID,
       shapeType AS gadm_level, w.wkt AS wkt_geometry_state
FROM adm1_raw a LEFT JOIN lv_wkt w ON w.rid = a.shapeID WHERE shapeName IS NOT NULL"""))
def q2_country_map_all_levels(spark, d):
    """The country-code map applied beyond ADM0 (Q2, parameter ``normalize_country``)."""
    return B.prepare_level(FX.adm1(spark, d), "ADM1", normalize_country=True)


@register("f7b_mismatch_counts", POSTAL_CTES + """
SELECT country, CAST(count(*) FILTER (WHERE state IS NULL) AS BIGINT) AS no_state,
       CAST(count(*) FILTER (WHERE city IS NULL) AS BIGINT) AS no_city
FROM postal WHERE state IS NULL OR city IS NULL GROUP BY country""")
def f7b_mismatch_counts(spark, d):
    """Mismatch report summarised per country."""
    return P.mismatch_counts(_postal(spark, d))


@register("k5b_upsert_state_table", _sql(FIX, O.polygon_ctes("lv", "adm1_raw"), body="""
SELECT country_code, state, shapeID, gadm_level, wkt_geometry_state FROM (
  SELECT shapeGroup AS country_code, replace(shapeName, ' ', '_') AS state, a.shapeID, shapeType AS gadm_level,
         w.wkt AS wkt_geometry_state,
         row_number() OVER (PARTITION BY shapeGroup, replace(shapeName, ' ', '_') ORDER BY a.shapeID DESC) AS rn
  FROM adm1_raw a LEFT JOIN lv_wkt w ON w.rid = a.shapeID
  WHERE shapeName IS NOT NULL AND shapeGroup IS NOT NULL) WHERE rn = 1"""))
def k5b_upsert_state_table(spark, d):
    """The shipped job's store step: ADM1 rows upserted into the state table keyed
    (country_code, state), the row last by shapeID winning; null-key rows are rejected."""
    from geoprep.operators.keyed import upsert
    from geoprep.spec import LEVELS
    rows = B.prepare_level(FX.adm1(spark, d), "ADM1")
    table, _ = upsert(rows.limit(0), rows, list(LEVELS["ADM1"].key), ["shapeID"])
    return table


@register("w1_load_level_cached", ADM1_SQL)
def w1_load_level_cached(spark, d):
    """The boundary job's load step: GeoPackage files read through the cache (the second
    load is a cache hit), then the level prepared."""
    from geoprep.operators.cache import FrameCache
    from geoprep.plans.jobs import load_boundaries
    from geoprep.sources.sqlite import write_feature_files
    folder = _scratch(spark, "adm1-gpkg")
    write_feature_files(FX.adm1(spark, d), folder, "adm1").collect()
    cache = FrameCache(ttl_minutes=15)
    first = load_boundaries(spark, folder, table="adm1", cache=cache)
    again = load_boundaries(spark, folder, table="adm1", cache=cache)
    assert again is first and load_boundaries(spark, folder + "-missing", cache=cache) is None
    return B.prepare_level(again, "ADM1")
