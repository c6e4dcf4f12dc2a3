"""Per-level table specifications and fixed values.

One ``LevelSpec`` per administrative level replaces the separate column lists, table
names, partition lists and key lists a boundary job needs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------
# They must equal the studied pipeline's for equal results.
# ISO-3 -> ISO-2 country codes; a code that is not listed stays as it is.
COUNTRY_CODE_MAP = {
    "USA": "US",
    "GBR": "GB",
    "DEU": "DE",
    "FRA": "FR",
    "ESP": "ES",
    "ITA": "IT",
    "NLD": "NL",
    "CHN": "CN",
    "JPN": "JP",
    "CAN": "CA",
    "AUS": "AU",
    "BRA": "BR",
    "IND": "IN",
    "RUS": "RU",
    "MEX": "MX",
    "ZAF": "ZA",
}
# Country filter of the postal gazetteer load.
POSTAL_COUNTRIES = ("USA", "US")
# Postal output columns, in order.
POSTAL_COLUMNS = ("country", "state", "city", "postal_code", "lat", "lon", "wkt_geometry")
# Types of the postal columns.
POSTAL_SCHEMA = ("country string, state string, city string, postal_code string, lat double, lon double, "
                 "wkt_geometry string")
# Partition columns of the postal table.
POSTAL_PARTITIONS = ("country", "state", "city")
# Key of the postal serving table: partition key (country, state, city), clustering postal_code.
POSTAL_KEY = ("country", "state", "city", "postal_code")
# Default cache lifetime in minutes (the shipped boundary job uses 15).
CACHE_TTL_MINUTES = 60
# Rows per chunk of the incremental postal load.
POSTAL_CHUNK_ROWS = 100_000
# Byte limit of a write batch (5,120 KB) and row count of a count-bounded batch.
BATCH_MAX_BYTES = 5120 * 1024
BATCH_ROWS = 5
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LevelSpec:
    """What one boundary level looks like once prepared.

    ``rename`` maps raw columns to output names, ``name_column`` is the renamed
    ``shapeName`` (spaces become ``_``), ``wkt_column`` receives the geometry as WKT,
    ``columns`` is the output projection, ``not_null`` the columns whose null rows are
    dropped, ``partition_by`` the file partitioning and ``key`` the serving-table key.
    """

    level: str
    depth: int
    rename: dict
    name_column: str
    wkt_column: str
    columns: tuple
    not_null: tuple = ()
    partition_by: tuple = ()
    table: str = ""
    key: tuple = ()
    map_country: bool = False
    country_column: str = "country_code"
    literal_level: bool = False
    keep_all: bool = False
    drop: tuple = field(default=("geometry",))


# The shipped boundary job: fixed projections per level.
LEVELS = {
    "ADM0": LevelSpec(
        level="ADM0", depth=0,
        rename={"shapeGroup": "country_code", "shapeType": "gadm_level", "shapeName": "country_full_name"},
        name_column="country_full_name", wkt_column="wkt_geometry_country",
        columns=("country_code", "country_full_name", "gadm_level"),
        partition_by=(), table="gadm0_data", key=("country_code",), map_country=True,
    ),
    "ADM1": LevelSpec(
        level="ADM1", depth=1,
        rename={"shapeGroup": "country_code", "shapeType": "gadm_level", "shapeName": "state"},
        name_column="state", wkt_column="wkt_geometry_state",
        columns=("country_code", "state", "shapeID", "gadm_level", "wkt_geometry_state"),
        not_null=("state",), partition_by=("country_code",), table="gadm1_data",
        key=("country_code", "state"),
    ),
    "ADM2": LevelSpec(
        level="ADM2", depth=2,
        rename={"shapeGroup": "country_code", "shapeType": "gadm_level", "shapeName": "city"},
        name_column="city", wkt_column="wkt_geometry_city",
        columns=("country_code", "city", "shapeID", "gadm_level"),
        not_null=("city",), partition_by=("country_code",), table="gadm2_data",
        key=("country_code", "city"),
    ),
}

# Development variant: keeps the WKT of every level and has no name filter.
DEV_LEVELS = {
    "ADM0": LevelSpec(
        level="ADM0", depth=0, rename=LEVELS["ADM0"].rename, name_column="country_full_name",
        wkt_column="wkt_geometry_country",
        columns=("country_code", "country_full_name", "gadm_level", "wkt_geometry_country"),
        table="gadm0_data", key=("country_code",), map_country=True,
    ),
    "ADM1": LevelSpec(
        level="ADM1", depth=1, rename=LEVELS["ADM1"].rename, name_column="state",
        wkt_column="wkt_geometry_state",
        columns=("country_code", "state", "shapeID", "gadm_level", "wkt_geometry_state"),
        partition_by=("country_code",), table="gadm1_data", key=("country_code", "state"),
    ),
    "ADM2": LevelSpec(
        level="ADM2", depth=2, rename=LEVELS["ADM2"].rename, name_column="city",
        wkt_column="wkt_geometry_city",
        columns=("country_code", "city", "shapeID", "gadm_level", "wkt_geometry_city"),
        partition_by=("country_code",), table="gadm2_data", key=("country_code", "city"),
    ),
}

# Combined-hierarchy variant: every raw column but the geometry is kept, the level is a
# literal column, and only ADM0 renames its group column (to ``country``).
COMBINED_LEVELS = {
    "ADM0": LevelSpec(
        level="ADM0", depth=0, rename={"shapeGroup": "country", "shapeName": "country_full_name"},
        name_column="country_full_name", wkt_column="wkt_geometry_country", columns=(),
        map_country=True, country_column="country", literal_level=True, keep_all=True,
    ),
    "ADM1": LevelSpec(
        level="ADM1", depth=1, rename={"shapeName": "state"}, name_column="state",
        wkt_column="wkt_geometry_state", columns=(), literal_level=True, keep_all=True,
    ),
    "ADM2": LevelSpec(
        level="ADM2", depth=2, rename={"shapeName": "city"}, name_column="city",
        wkt_column="wkt_geometry_city", columns=(), literal_level=True, keep_all=True,
    ),
}

# Key of the combined hierarchy's de-duplication.
COMBINED_KEY = ("shapeGroup", "country", "state", "city")

LEVEL_DEPTH = {name: spec.depth for name, spec in LEVELS.items()}
