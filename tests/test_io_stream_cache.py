"""Sinks, incremental load and the cache."""
import os

import pytest
from pyspark.sql import functions as F

from geoprep.operators.boundary import prepare_level
from geoprep.operators.cache import FrameCache
from geoprep.sources import fixtures as FX
from geoprep.sources.tables import load_or_skip, read_back, write_keyed, write_table

from conftest import SF001


def test_keyed_write_reports_and_parallel_write_tasks(spark, tmp_dir):
    import glob
    df = spark.createDataFrame([("a", 1, "x"), (None, 2, "x"), ("b", None, None), (None, None, "y"), ("a", 1, "x")], "k string, n int, lang string")
    report = write_keyed(df, f"{tmp_dir}/keyed", ["k", "n"], table="t", rejects_path=f"{tmp_dir}/bad", partition_by=["k"])
    assert {tuple(r) for r in report.collect()} == {("t", "written", None, 2), ("t", "rejected", "null key column k", 2),
                                                    ("t", "rejected", "null key column n", 1)}
    assert spark.read.parquet(f"{tmp_dir}/keyed").count() == 2 and spark.read.parquet(f"{tmp_dir}/bad").count() == 3
    assert write_keyed(df.where("false"), f"{tmp_dir}/none", ["k"], table="t").count() == 0
    wide = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    write_table(wide, f"{tmp_dir}/spread", partitions=5)
    assert len(glob.glob(f"{tmp_dir}/spread/part-*")) == 5 and spark.read.parquet(f"{tmp_dir}/spread").count() == 1000


def test_write_modes_and_guard(spark, tmp_dir):
    df = prepare_level(FX.adm1(spark, SF001), "ADM1")
    path = f"{tmp_dir}/gadm1"
    write_table(df, path, partition_by=["country_code"])
    write_table(df, path, mode="append", partition_by=["country_code"])
    assert read_back(spark, path, df).count() == 2 * df.count()
    write_table(df, path, mode="overwrite", partition_by=["country_code"])
    assert read_back(spark, path, df).count() == df.count()
    with pytest.raises(ValueError):
        write_table(df, path, mode="merge")
    assert write_table(df.where("false"), f"{tmp_dir}/empty", skip_empty=True) is False


def test_empty_string_partition_reads_back_null(spark, tmp_dir):
    df = spark.createDataFrame([("", 1), (None, 2), ("a", 3)], "p string, v int")
    write_table(df, f"{tmp_dir}/t", partition_by=["p"])
    got = sorted(((r["p"], r["v"]) for r in read_back(spark, f"{tmp_dir}/t", df).collect()), key=lambda t: t[1])
    assert got == [(None, 1), (None, 2), ("a", 3)]


def test_missing_source_is_skipped(spark, tmp_dir):
    df, rep = load_or_skip(spark, f"{tmp_dir}/nope.parquet")
    assert df is None and rep["status"] == "skipped"


def test_cache_ttl(spark):
    now = [0.0]
    cache = FrameCache(ttl_minutes=1, clock=lambda: now[0])
    df = spark.range(3)
    cache.set("k", df)
    now[0] = 59.0
    assert cache.get("k") is not None
    now[0] = 60.0                       # strict: age must be below the lifetime
    assert cache.get("k") is None and "k" not in cache
    cache.set("a", df)
    cache.set("b", df)
    cache.invalidate("a")
    assert "a" not in cache and "b" in cache
    cache.clear()
    assert len(cache) == 0


def test_chunked_load_equals_one_shot(spark, tmp_dir):
    from geoprep.operators.postal import enrich_postal, gazetteer_records
    from geoprep.streaming.incremental import chunked_load, stage_records
    spr, gj = FX.spr(spark, SF001), FX.geojson(spark, SF001)
    adm1, adm2 = FX.adm1(spark, SF001), FX.adm2(spark, SF001)
    recs = stage_records(gazetteer_records(spr, gj), f"{tmp_dir}/records", chunk_rows=20)
    stats = chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/postal", checkpoint=f"{tmp_dir}/ckpt")
    one = enrich_postal(spr, gj, adm1, adm2)
    got = read_back(spark, f"{tmp_dir}/postal", one)
    assert stats["chunks"] >= 4
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str(tuple(r)) for r in one.collect())
    # a rerun resumes from the checkpoint: nothing new to append
    again = chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/postal", checkpoint=f"{tmp_dir}/ckpt")
    assert again["chunks"] == 0


def test_lookup_prunes_partitions(spark, tmp_dir):
    from geoprep.operators.profile import lookup
    df = prepare_level(FX.adm2(spark, SF001), "ADM2")
    write_table(df, f"{tmp_dir}/g2", partition_by=["country_code", "city"])
    found = lookup(read_back(spark, f"{tmp_dir}/g2", df), "USA", city="City_5", country_col="country_code")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert found.count() == df.where("country_code = 'USA' AND city = 'City_5'").count()


def test_replayed_chunks_are_not_appended_twice(spark, tmp_dir):
    from geoprep.operators.postal import gazetteer_records
    from geoprep.streaming.incremental import chunked_load, stage_records
    spr, gj = FX.spr(spark, SF001), FX.geojson(spark, SF001)
    adm1, adm2 = FX.adm1(spark, SF001), FX.adm2(spark, SF001)
    recs = stage_records(gazetteer_records(spr, gj), f"{tmp_dir}/records", chunk_rows=40)
    first = chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/postal", checkpoint=f"{tmp_dir}/ckpt1")
    n = spark.read.parquet(f"{tmp_dir}/postal").count()
    # a lost stream checkpoint replays every batch id: the commit markers skip them
    again = chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/postal", checkpoint=f"{tmp_dir}/ckpt2")
    assert first["chunks"] >= 2 and again["chunks"] == 0
    assert spark.read.parquet(f"{tmp_dir}/postal").count() == n == first["rows"]


def test_level_job_reports_the_written_rows_once(spark, tmp_dir):
    from geoprep.plans.jobs import run_level
    rep = run_level(spark, FX.adm1(spark, SF001), "ADM1", tmp_dir)
    written = spark.read.parquet(rep["path"]).count()
    assert rep["status"] == "written" and rep["rows"] == written > 0 and rep["mb"] > 0
    skipped = run_level(spark, None, "ADM2", tmp_dir)
    assert skipped["status"] == "skipped"


def test_second_load_and_resume_lose_no_rows(spark, tmp_dir):
    from geoprep.operators.postal import gazetteer_records
    from geoprep.streaming.incremental import chunked_load, stage_records
    adm1, adm2 = FX.adm1(spark, SF001), FX.adm2(spark, SF001)
    recs = gazetteer_records(FX.spr(spark, SF001), FX.geojson(spark, SF001))
    one = recs.count()
    staged = stage_records(recs, f"{tmp_dir}/a", chunk_rows=40)
    limited = chunked_load(spark, staged, adm1, adm2, f"{tmp_dir}/t", max_chunks=1)
    rest = chunked_load(spark, staged, adm1, adm2, f"{tmp_dir}/t")
    assert limited["chunks"] == 1 and rest["chunks"] >= 1
    n = spark.read.parquet(f"{tmp_dir}/t").count()
    assert n == limited["rows"] + rest["rows"] >= one
    chunked_load(spark, stage_records(recs, f"{tmp_dir}/b", chunk_rows=1000), adm1, adm2, f"{tmp_dir}/t")   # another load
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2 * n


def test_serving_twice_adds_up(spark, tmp_dir):
    from geoprep.plans.jobs import store_postal
    from geoprep.spec import POSTAL_SCHEMA
    for code, lat in (("1", 1.0), ("2", 2.0), ("1", 3.0)):
        spark.createDataFrame([("USA", "S", "C", code, lat, 0.0, "POINT (0 0)")], POSTAL_SCHEMA).write.mode("overwrite").parquet(f"{tmp_dir}/p")
        store_postal(spark, f"{tmp_dir}/p", tmp_dir)
    assert {(r["postal_code"], r["lat"]) for r in spark.read.parquet(f"{tmp_dir}/wof_data").collect()} == {("1", 3.0), ("2", 2.0)}


def test_combined_needs_every_level(spark):
    from geoprep.operators.boundary import combine_levels
    with pytest.raises(ValueError, match="ADM0"):
        combine_levels({"ADM1": FX.adm1(spark, SF001), "ADM2": FX.adm2(spark, SF001), "ADM0": None})


def test_a_load_killed_after_its_write_holds_each_chunk_once(spark, tmp_dir, monkeypatch):
    from geoprep.operators.postal import gazetteer_records
    from geoprep.streaming import incremental as I
    adm1, adm2 = FX.adm1(spark, SF001), FX.adm2(spark, SF001)
    recs = I.stage_records(gazetteer_records(FX.spr(spark, SF001), FX.geojson(spark, SF001)), f"{tmp_dir}/r", chunk_rows=60)
    write = I.write_table
    calls = []

    def dies_after_the_second_write(*a, **kw):
        write(*a, **kw)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")                     # after the commit, before the marker

    monkeypatch.setattr(I, "write_table", dies_after_the_second_write)
    with pytest.raises(Exception, match="killed"):
        I.chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/t")
    monkeypatch.setattr(I, "write_table", write)
    I.chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/t")
    whole = I.chunked_load(spark, I.stage_records(spark.read.parquet(recs), f"{tmp_dir}/r2", chunk_rows=100_000), adm1, adm2, f"{tmp_dir}/u")
    a, b = (spark.read.parquet(f"{tmp_dir}/{x}").drop(I.CHUNK_COLUMN) for x in "tu")
    assert a.count() == b.count() == whole["rows"] and a.exceptAll(b).count() == 0
    chunks = spark.read.parquet(f"{tmp_dir}/t").select(I.CHUNK_COLUMN).distinct().count()
    assert chunks == len(spark.read.parquet(recs).inputFiles())


def _files(path):
    import glob
    return {f: open(f, "rb").read() for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_merge_rewrites_only_the_partitions_of_the_batch(spark, tmp_dir):
    from geoprep.sources.tables import merge_table, read_stored
    schema = "p string, k long, v long, note string"
    path = f"{tmp_dir}/t"
    first = spark.createDataFrame([("a", 1, 1, "x"), ("b", 1, 1, "x"), ("007", 1, 1, "x"), (None, 9, 9, "x")], schema)
    rejected = merge_table(spark, first, path, ["p", "k"], ["v"], partition_by=["p"])
    assert [r["reject_reason"] for r in rejected.collect()] == ["null key column p"]
    before = _files(path)
    batch = spark.createDataFrame([("b", 1, 5), ("b", 2, 1), ("b", 2, 7), ("c", 1, 1)], "p string, k long, v long")     # lacks a column
    for _ in range(2):
        merge_table(spark, batch, path, ["p", "k"], ["v"], partition_by=["p"])
    after = _files(path)
    kept = {f for f in before if "p=a" in f or "p=007" in f}
    assert len(kept) == 2 and all(after.get(f) == before[f] for f in kept)             # untouched files keep their names
    got = sorted(tuple(r) for r in read_stored(spark, path, first, ["p"]).select("p", "k", "v", "note").collect())
    assert got == [("007", 1, 1, "x"), ("a", 1, 1, "x"), ("b", 1, 5, None), ("b", 2, 7, None), ("c", 1, 1, None)]
    plan = read_stored(spark, path, first, ["p"]).where(F.col("p").isin(["b", "c"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    with pytest.raises(ValueError, match="part of the key"):
        merge_table(spark, first, path, ["k"], ["v"], partition_by=["p"])
    merge_table(spark, first.limit(0), path, ["p", "k"], ["v"], partition_by=["p"])    # an empty batch changes nothing
    assert read_stored(spark, path, first, ["p"]).count() == 5


def test_rejects_of_a_batch_are_kept_once(spark, tmp_dir):
    from geoprep.plans.jobs import store_postal
    from geoprep.spec import POSTAL_SCHEMA
    spark.createDataFrame([("USA", None, "C", "1", 1.0, 0.0, "POINT (0 0)"), ("USA", "S", "C", "2", 1.0, 0.0, "POINT (0 0)")],
                          POSTAL_SCHEMA).write.parquet(f"{tmp_dir}/p")
    for _ in range(3):
        store_postal(spark, f"{tmp_dir}/p", tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/wof_data").count() == 1 and spark.read.parquet(f"{tmp_dir}/wof_data_rejects").count() == 1


def test_unreadable_source_is_skipped_and_other_faults_raise(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/empty")
    assert load_or_skip(spark, f"{tmp_dir}/empty")[1]["status"] == "skipped"
    with open(f"{tmp_dir}/no.parquet", "w") as f:
        f.write("this is no table")
    assert load_or_skip(spark, f"{tmp_dir}/no.parquet")[1]["status"] == "skipped"
    with pytest.raises(Exception):
        load_or_skip(spark, "nofs://host/table")


def test_a_write_computes_its_input_once_and_cuts_a_hot_value(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) AS p", "id", "sha2(string(id), 512) AS s")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.files.maxRecordsPerFile": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_table(df.mapInPandas(count, df.schema), f"{tmp_dir}/t", partition_by=["p"])
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert seen.value == 60_000
    assert len(_files(f"{tmp_dir}/t/p=hot")) > 2 and spark.read.parquet(f"{tmp_dir}/t").count() == 60_000


def test_rows_without_a_geometry_are_spread(spark):
    from geoprep.functions import geometry as G
    from geoprep.operators.spatial import spatial_join, with_match_keys
    left = spark.range(0, 3000, 1, 4).select("id", G.point(F.when(F.col("id") % 3 > 0, F.col("id") % 10), F.lit(1)).alias("geometry"))
    keyed = with_match_keys(left).where("geometry IS NULL")
    sizes = [r["count"] for r in keyed.repartition(16, "__px", "__py", "__gk").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 1000 / 16
    square = F.struct(F.lit("Polygon").alias("kind"), G.literal_parts([[[(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)]]]).alias("parts"))
    out = spatial_join(left, spark.range(1).select(F.lit("a").alias("pid"), square.alias("geometry")))
    assert out.count() == 3000 and out.where("geometry IS NULL AND pid IS NOT NULL").count() == 0


def test_small_folders_are_written_by_many_tasks(spark, tmp_dir):
    df = spark.range(0, 6000, 1, 4).selectExpr("concat('a', id % 100) AS a", "concat('b', id % 300) AS b", "id")
    write_table(df, f"{tmp_dir}/t", partition_by=["a", "b"], deal_by=["a"])
    files = _files(f"{tmp_dir}/t/a=*/b=*")
    tasks = {(f.split("/a=")[1].split("/")[0], f.rsplit("part-", 1)[1][:5]) for f in files}
    assert len(files) == 300 and len(tasks) == 100            # the folders of one a come from one task
    assert len({t for _, t in tasks}) > 2                     # not merged by size alone
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 6000
    with pytest.raises(ValueError, match="deal_by"):
        write_table(df, f"{tmp_dir}/u", partition_by=["a"], deal_by=["b"])


def test_many_chunks_share_a_few_micro_batches(spark, tmp_dir, monkeypatch):
    from geoprep.operators.postal import gazetteer_records
    from geoprep.streaming import incremental as I
    adm1, adm2 = FX.adm1(spark, SF001), FX.adm2(spark, SF001)
    recs = I.stage_records(gazetteer_records(FX.spr(spark, SF001), FX.geojson(spark, SF001)), f"{tmp_dir}/r", chunk_rows=12)
    n = len(I.staged_files(spark, recs))
    write, calls = I.write_table, []
    monkeypatch.setattr(I, "write_table", lambda *a, **kw: calls.append(1) or write(*a, **kw))
    first = I.chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/t", max_chunks=4)
    assert first["chunks"] == 4 and spark.read.parquet(f"{tmp_dir}/t").select(I.CHUNK_COLUMN).distinct().count() == 4
    rest = I.chunked_load(spark, recs, adm1, adm2, f"{tmp_dir}/t")
    assert first["chunks"] + rest["chunks"] == n >= 7
    assert len(calls) <= 2 + I.MICRO_BATCHES < n
    got = spark.read.parquet(f"{tmp_dir}/t")
    assert got.select(I.CHUNK_COLUMN).distinct().count() == n and got.count() == first["rows"] + rest["rows"]


def _odd_folders(spark):
    rows = [("a'b", "x/y=%", 1, float("nan")), (None, "", 2, 3.0), ("é +%2B ü", "z%20+ 日\n", 3, None), ("p=1/q=2", " lead", 4, 4.0),
            ("é +%2B ü", "z%20+ 日\n", 5, 1.0)]
    return spark.createDataFrame(rows, "p string, q string, n long, v double")


def _folders(path):
    return {os.path.relpath(at, path) for at, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)}


def test_many_folders_are_written_as_by_spark_and_read_without_discovery(spark, tmp_dir):
    """``deal_by`` tables: Spark's folders, types and rows, no checksum files (each one a process started)."""
    df, here = _odd_folders(spark), f"{tmp_dir}/p=7"                # a folder above the table is no value
    write_table(df, f"{here}/spark", partition_by=["p", "q"])
    write_table(df, f"{here}/many", partition_by=["p", "q"], deal_by=["p"])
    assert _folders(f"{here}/many") == _folders(f"{here}/spark") and len(_folders(f"{here}/many")) == 4
    assert not [f for _, _, files in os.walk(f"{here}/many") for f in files if f.endswith(".crc")]
    want = sorted(map(str, read_back(spark, f"{here}/spark", df).collect()))
    for name in ("spark", "many"):
        assert sorted(map(str, read_back(spark, f"{here}/{name}", df).collect())) == want
        got = read_back(spark, f"{here}/{name}", df, partition_by=["p", "q"])
        assert got.schema == df.schema and sorted(map(str, got.collect())) == want
        assert got.where("v > 5").count() == 1 and got.where("p is null").count() == 1     # NaN is above all
    assert spark.read.parquet(f"{here}/many").schema == spark.read.parquet(f"{here}/spark").schema
    write_table(df, f"{here}/many", mode="append", partition_by=["p", "q"], deal_by=["p"])
    assert read_back(spark, f"{here}/many", df, partition_by=["p", "q"]).count() == 10
    write_table(df.where("n = 1"), f"{here}/many", partition_by=["p", "q"], deal_by=["p"])
    assert [r.n for r in read_back(spark, f"{here}/many", df, partition_by=["p", "q"]).collect()] == [1]


def test_many_folders_keep_types_and_typed_partitions(spark, tmp_dir):
    df = spark.sql("""SELECT CAST(id % 3 AS INT) AS k, DATE'2020-01-01' + CAST(id % 2 AS INT) AS d, CAST(id % 100 AS TINYINT) AS t, CAST(id AS FLOAT) AS f,
        id % 2 = 0 AS b, TIMESTAMP'1500-01-01 00:00:01' AS ts, TIMESTAMP_NTZ'2020-01-01 00:00:01' AS tn, DATE'1400-02-03' AS old,
        CAST('x' AS BINARY) AS bin, IF(id = 1, NULL, CAST(id AS STRING)) AS s FROM range(25000)""")
    write_table(df, f"{tmp_dir}/t", partition_by=["k", "d"], deal_by=["k"])
    got = read_back(spark, f"{tmp_dir}/t", df, partition_by=["k", "d"])
    assert len(_folders(f"{tmp_dir}/t")) == 6 and dict(got.dtypes) == dict(df.dtypes)
    assert got.exceptAll(df).isEmpty() and df.exceptAll(got).isEmpty()
    with_list = df.withColumn("l", F.array("s"))                     # not flat: Spark's writer
    write_table(with_list, f"{tmp_dir}/l", partition_by=["k", "d"], deal_by=["k"])
    assert read_back(spark, f"{tmp_dir}/l", with_list, partition_by=["k", "d"]).exceptAll(with_list).isEmpty()


def test_many_folders_failed_write_leaves_the_table(spark, tmp_dir):
    df = _odd_folders(spark)
    write_table(df, f"{tmp_dir}/t", partition_by=["p", "q"], deal_by=["p"])
    bad = df.withColumn("v", F.when(F.col("n") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("v")).cast("double"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="no"):
            write_table(bad, f"{tmp_dir}/t", mode=mode, partition_by=["p", "q"], deal_by=["p"])
        assert read_back(spark, f"{tmp_dir}/t", df, partition_by=["p", "q"]).count() == 5
        assert not [n for n in os.listdir(f"{tmp_dir}/t") if n.startswith("_temp")]


def test_folders_are_listed_by_a_few_tasks(spark, tmp_dir):
    df = spark.range(300).select(F.col("id").cast("string").alias("p"), "id")
    write_table(df, f"{tmp_dir}/t", partition_by=["p"], deal_by=["p"])
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    for kw in ({}, {"partition_by": ["p"]}):
        group = f"listing-{len(kw)}-{tmp_dir}"
        spark.sparkContext.setJobGroup(group, "listing")
        got = read_back(spark, f"{tmp_dir}/t", df, **kw)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        status = spark.sparkContext.statusTracker()
        tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds]
        assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism < 300
        assert got.count() == 300
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
