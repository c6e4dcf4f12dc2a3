"""Boundary levels: per-level preparation and the combined hierarchy.

All transforms are one Catalyst projection plus a filter per level (P1, P2, P4, P5, X1,
X2, X8, F1, F2) and, for the hierarchy, a union by name and an aggregate (U1, A5, O1).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoprep.functions import geometry as G
from geoprep.functions.text import map_country, underscore
from geoprep.spec import COMBINED_KEY, COMBINED_LEVELS, LEVELS, LevelSpec


def prepare_level(raw: DataFrame, spec: LevelSpec | str, *, drop_null_country: bool = False,
                  normalize_country: bool | None = None, geometry_col: str = "geometry") -> DataFrame:
    """Raw boundary rows -> the level's table.

    Renames per ``spec.rename``; maps country codes when the spec says so (only ADM0 in
    the shipped job; ``normalize_country=True`` forces it for every level); spaces in the
    name become ``_``; the geometry becomes WKT; then the projection and the not-null
    filter of the spec.  ``drop_null_country`` applies the country filter the shipped job
    computes and then discards (off by default, as there).
    """
    if isinstance(spec, str):
        spec = LEVELS[spec]
    df = raw.withColumnsRenamed(spec.rename)
    do_map = spec.map_country if normalize_country is None else normalize_country
    changes = {}
    if do_map and spec.country_column in df.columns:
        changes[spec.country_column] = map_country(spec.country_column)
    if spec.name_column in df.columns:
        changes[spec.name_column] = underscore(spec.name_column)
    if geometry_col in df.columns:
        changes[spec.wkt_column] = G.to_wkt(geometry_col)
    if spec.literal_level:
        changes["gadm_level"] = F.lit(spec.level)
    df = df.withColumns(changes)
    if spec.keep_all:
        df = df.drop(*[c for c in spec.drop if c in df.columns])
    else:
        df = df.select(*spec.columns)
    for c in spec.not_null:
        df = df.where(F.col(c).isNotNull())
    if drop_null_country:
        df = df.where(F.col(spec.country_column).isNotNull())
    return df


def union_levels(frames: list) -> DataFrame:
    """Union by name; a column absent from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Keep, per key, the row that sorts first by ``order`` (a list of columns, ascending;
    nulls first).  Null keys form one group.

    Implemented as ``min(struct(order..., row))`` per key: an aggregate with a map-side
    partial step, so a key holding a large share of all rows is combined before the
    shuffle instead of being sorted inside one task as a window partition would be.
    """
    payload = F.struct(*[F.col(c) for c in df.columns]).alias("__row")
    ordered = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], payload)
    keys = list(keys)
    out = df.groupBy(*keys).agg(F.min(ordered).alias("__m"))
    return out.select(*[F.col("__m.__row")[c].alias(c) for c in df.columns])


def combine_levels(levels: dict, *, key=COMBINED_KEY) -> DataFrame:
    """Combined hierarchy (W3): ADM2, ADM1, ADM0 unioned by name, then one row per
    (shapeGroup, country, state, city), the deepest level first (O1, A5); equal levels are
    decided by shapeID, then by name (our tie-break).  All three levels must be there: a
    hierarchy without one would silently lose its rows."""
    missing = [lvl for lvl in COMBINED_LEVELS if levels.get(lvl) is None]
    if missing:
        raise ValueError(f"combined hierarchy needs every level; missing: {', '.join(sorted(missing))}")
    frames = [prepare_level(levels[lvl], COMBINED_LEVELS[lvl]) for lvl in ("ADM2", "ADM1", "ADM0")]
    u = union_levels(frames)
    for k in key:
        if k not in u.columns:
            u = u.withColumn(k, F.lit(None).cast("string"))
    depth = F.coalesce(*[F.when(F.col("gadm_level") == s.level, F.lit(s.depth)) for s in COMBINED_LEVELS.values()],
                       F.lit(-1))
    name = F.coalesce(*[F.col(c) for c in ("city", "state", "country_full_name") if c in u.columns])
    return first_per_key(u, key, [-depth, F.col("shapeID"), name])
