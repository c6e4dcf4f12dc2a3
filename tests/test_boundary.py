"""Boundary levels and the combined hierarchy on the derived fixtures."""
from pyspark.sql import functions as F

from geoprep.operators.boundary import combine_levels, prepare_level
from geoprep.sources import fixtures as FX

from conftest import SF001


def test_level_projection_and_filters(spark):
    raw = FX.boundaries(spark, SF001)
    adm0 = prepare_level(raw["ADM0"], "ADM0")
    assert adm0.columns == ["country_code", "country_full_name", "gadm_level"]
    codes = {r[0] for r in adm0.select("country_code").distinct().collect()}
    assert codes == {"US", "GB", "DE", "FRO", None}           # mapped, unmapped kept, null kept
    adm1 = prepare_level(raw["ADM1"], "ADM1")
    assert adm1.where(F.col("state").isNull()).count() == 0
    assert adm1.where(F.col("state").contains(" ")).count() == 0
    adm1_all = prepare_level(raw["ADM1"], "ADM1", normalize_country=True, drop_null_country=True)
    assert adm1_all.where(F.col("country_code").isNull()).count() == 0
    assert {r[0] for r in adm1_all.select("country_code").distinct().collect()} <= {"US", "GB", "DE", "FRO"}


def test_combined_hierarchy_keeps_deepest_level(spark):
    raw = FX.boundaries(spark, SF001)
    c = combine_levels(raw)
    keys = c.groupBy("shapeGroup", "country", "state", "city").count()
    assert keys.where("count > 1").count() == 0
    # the all-null key is shared by levels; the deepest one wins
    nulls = c.where("shapeGroup IS NULL AND country IS NULL AND state IS NULL AND city IS NULL").collect()
    assert all(r["gadm_level"] == "ADM2" for r in nulls)


def test_empty_input_gives_empty_output(spark):
    raw = FX.adm1(spark, SF001).where("false")
    assert prepare_level(raw, "ADM1").count() == 0


def test_null_geometry_gives_null_wkt(spark):
    raw = FX.adm1(spark, SF001).withColumn("geometry", F.when(F.col("shapeID") == "S1", F.lit(None)).otherwise(F.col("geometry")))
    out = {r["shapeID"]: r["wkt_geometry_state"] for r in prepare_level(raw, "ADM1").collect()}
    assert out["S1"] is None and out["S2"].startswith("MULTIPOLYGON")
