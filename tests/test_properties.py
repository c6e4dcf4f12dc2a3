"""Properties: results do not depend on partitioning; the entry point runs."""
from geoprep.operators.postal import enrich_postal
from geoprep.sources import fixtures as FX

from conftest import SF001


def _postal(spark):
    return enrich_postal(FX.spr(spark, SF001), FX.geojson(spark, SF001), FX.adm1(spark, SF001), FX.adm2(spark, SF001))


def test_shuffle_partitions_do_not_change_the_postal_table(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(str(tuple(r)) for r in _postal(spark).collect()))
        assert results[0] == results[1] and len(results[0]) > 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_entry_runs_with_a_stable_schema(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["country", "state", "city", "postal_code", "lat", "lon", "wkt_geometry"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_plain_table_reads_are_not_copied_by_staging(spark, tmp_dir):
    from pyspark.sql import functions as F

    from geoprep.operators.stage import is_plain_scan, stage
    spark.range(10).write.parquet(f"{tmp_dir}/t")
    scan = spark.read.parquet(f"{tmp_dir}/t").where("id > 2").select(F.col("id").alias("k"))
    assert is_plain_scan(scan) and stage(scan) is scan
    computed = scan.withColumn("j", F.col("k") * 2)
    assert not is_plain_scan(computed)
    staged = stage(computed)
    assert staged is not computed and staged.count() == 7
