"""Postal gazetteer: record load, body parse and enrichment with state and city.

``enrich_postal`` is one lazy DataFrame from the record/body join to the final
projection; nothing is materialised between stages except (optionally) the parsed
records, which several branches of the plan read.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoprep.functions import geometry as G
from geoprep.functions.text import underscore
from geoprep.operators import spatial as S
from geoprep.spec import POSTAL_COLUMNS, POSTAL_COUNTRIES


def gazetteer_records(spr: DataFrame, geojson: DataFrame, countries=POSTAL_COUNTRIES) -> DataFrame:
    """Records joined to their bodies, filtered by country.

    Columns: id, country, postal_code, geojson_data.  A record without a body (or a body
    without a record) drops out, as in an inner join.
    """
    rec = spr.where(F.col("country").isin(*countries)) if countries else spr
    rec = rec.select("id", "country", F.col("name").alias("postal_code"))
    body = geojson.select("id", F.col("body").alias("geojson_data"))
    return rec.join(body, "id", "inner")


def parse_records(records: DataFrame, body_col: str = "geojson_data") -> DataFrame:
    """Adds geometry, city (postal locality), lat, lon; drops the JSON.

    A body that fails to parse gives a null geometry and city and NaN coordinates.
    """
    out = G.parse_gazetteer(records, body_col)
    out = out.withColumns({"lat": G.to_float_or_nan(F.col("lat_text")), "lon": G.to_float_or_nan(F.col("lon_text"))})
    return out.drop("lat_text", "lon_text", body_col)


def state_polygons(adm1: DataFrame) -> DataFrame:
    """Only the name and the geometry of the state level, name as ``state``."""
    return adm1.select(F.col("shapeName").alias("state"), "geometry")


def city_polygons(adm2: DataFrame) -> DataFrame:
    """Name as ``__gadm_city``, the polygon id for a stable pick, and the geometry."""
    return adm2.select(F.col("shapeName").alias("__gadm_city"), F.col("shapeID").alias("__city_id"), "geometry")


def enrich_postal(spr: DataFrame, geojson: DataFrame, adm1: DataFrame, adm2: DataFrame, *,
                  countries=POSTAL_COUNTRIES, crs: str = G.WGS84, boundary_crs: str = G.WGS84,
                  stage_mode: str | None = "checkpoint", max_edges: int = 16) -> DataFrame:
    """The postal table: country, state, city, postal_code, lat, lon, wkt_geometry.

    * every place meets the states its geometry intersects (closed test): a place on a
      shared border gets one row per state, a place in none one row with a null state;
    * the city is the postal locality when the body has one, else the city polygon the
      geometry meets -- one per distinct geometry, the first by (name, nulls last; then
      polygon id);
    * spaces in country, state and city become ``_``.

    The parsed records are staged once (``stage_mode``); states and cities are matched in one
    pass over the distinct geometries (an index of two layers) and joined back to them.
    """
    return enrich_records(gazetteer_records(spr, geojson, countries), adm1, adm2, crs=crs,
                          boundary_crs=boundary_crs, stage_mode=stage_mode, max_edges=max_edges)


def boundary_index(adm1: DataFrame, adm2: DataFrame, *, max_edges: int = 16, stage_mode: str | None = "checkpoint") -> S.PolygonIndex:
    """States (layer 0) and cities (layer 1) prepared once, as one index, for many matches."""
    return S.index_layers([state_polygons(adm1), city_polygons(adm2)], max_edges=max_edges, stage_mode=stage_mode)


def enrich_records(records: DataFrame, adm1: DataFrame | None = None, adm2: DataFrame | None = None, *,
                   crs: str = G.WGS84, boundary_crs: str = G.WGS84, stage_mode: str | None = "checkpoint",
                   max_edges: int = 16, index: S.PolygonIndex | None = None, keep: tuple = ()) -> DataFrame:
    """``enrich_postal`` from already joined records (id, country, postal_code,
    geojson_data) -- the body of one chunk of the incremental load.  ``index`` (from
    ``boundary_index``) reuses prepared boundaries instead of preparing them again; ``keep``
    names columns of the records to return as well."""
    parsed = parse_records(records)
    if crs.upper() != boundary_crs.upper():
        parsed = parsed.withColumn("geometry", G.to_crs(F.col("geometry"), crs, boundary_crs))
    with ThreadPoolExecutor(2) as pool:      # gazetteer staging and boundary indexing are independent
        staged = pool.submit(S._stage_left, parsed, "geometry", stage_mode)
        if index is None:
            index = pool.submit(boundary_index, adm1, adm2, max_edges=max_edges, stage_mode=stage_mode).result()
        parsed, has_shapes = staged.result()
    states, cities = S.match_layers(parsed, index, has_shapes=has_shapes, stage_mode=stage_mode)
    cities = S.first_of(cities, [F.isnull("__gadm_city"), F.col("__gadm_city"), F.col("__city_id")])
    keyed = S.with_match_keys(parsed)
    out = S.join_matches(S.join_matches(keyed, states), cities)
    out = out.withColumns({
        "city": F.coalesce(F.col("city"), F.col("__gadm_city")),
        "wkt_geometry": G.to_wkt(F.col("geometry")),
    })
    out = out.select(*POSTAL_COLUMNS, *keep)
    return out.withColumns({c: underscore(c) for c in ("country", "state", "city")})


def mismatches(postal: DataFrame) -> DataFrame:
    """Places without a state or a city."""
    return postal.where(F.col("state").isNull() | F.col("city").isNull()).select(
        "country", "state", "city", "postal_code")


def mismatch_counts(postal: DataFrame) -> DataFrame:
    """Per country: places without a state, without a city (F7 summary)."""
    m = mismatches(postal)
    return m.groupBy("country").agg(F.count(F.when(F.col("state").isNull(), 1)).alias("no_state"),
                                     F.count(F.when(F.col("city").isNull(), 1)).alias("no_city"))


def drop_null_island(df: DataFrame, geom_col: str = "geometry") -> DataFrame:
    """Drop point geometries at exactly (0, 0); other rows stay."""
    g = F.col(geom_col)
    at_origin = (g["kind"] == G.POINT) & (G.point_x(g) == 0) & (G.point_y(g) == 0)
    return df.where(~F.coalesce(at_origin, F.lit(False)))
