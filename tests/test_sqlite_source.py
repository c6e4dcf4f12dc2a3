"""The GeoPackage/SQLite source: record batches, box and filter pushdown, odd values."""
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

from geoprep.functions import geometry as G
from geoprep.sources import sqlite as Q


def _grid(spark, n=2000):
    return spark.range(n).repartition(1).sortWithinPartitions("id").select(
        "id", F.concat(F.lit("n"), (F.col("id") % 7).cast("string")).alias("name"),
        G.point((F.col("id") % 50).cast("double"), F.floor(F.col("id") / 50).cast("double")).alias("geometry"))


def _reader(path, **options):
    source = Q.GpkgDataSource({"path": path, **options})
    return source.reader(source.schema())


def _rows(reader):
    return sum(b.num_rows for p in reader.partitions() for b in reader.read(p))


def test_a_box_reads_fewer_rows_and_ranges(spark, tmp_dir):
    Q.write_feature_files(_grid(spark), tmp_dir, "t").collect()
    whole, part = _reader(tmp_dir, rows_per_partition="100"), _reader(tmp_dir, rows_per_partition="100", box="3,10,5,11")
    assert len(whole.partitions()) == 20 and _rows(whole) == 2000
    assert len(part.partitions()) <= 2 and _rows(part) == 6
    got = Q.read_features(spark, tmp_dir, columns=["id"], rows_per_partition=100, box=(3, 10, 5, 11))
    assert sorted(r["id"] for r in got.collect()) == [y * 50 + x for y in (10, 11) for x in (3, 4, 5)]
    with sqlite3.connect(Q._files(tmp_dir)[0]) as con:                     # a file without an R-tree gives the same
        con.execute('DROP TABLE "rtree_t_geometry"')
    assert _rows(_reader(tmp_dir, rows_per_partition="100", box="3,10,5,11")) == 6


def test_filters_reach_the_file(spark, tmp_dir):
    Q.write_feature_files(_grid(spark), tmp_dir, "t").collect()
    r = _reader(tmp_dir, columns="id,name", pushdown="true")
    filters = [EqualTo(("name",), "n3"), GreaterThan(("id",), 1000), In(("id",), (1004, 1011, 1012)), IsNotNull(("id",)), StringContains(("name",), "n")]
    assert list(r.pushFilters(filters)) == filters                         # Spark checks all of them again
    assert _rows(r) == 2                                                    # 1004 and 1011 of 2000
    old = spark.conf.get("spark.sql.python.filterPushdown.enabled", None)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = Q.read_features(spark, tmp_dir, columns=["id", "name"]).where("name = 'n3' AND id > 1990").collect()
        assert sorted(r["id"] for r in got) == [i for i in range(1991, 2000) if i % 7 == 3]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", old or "false")


def test_unknown_columns_raise_and_odd_values_are_null(spark, tmp_dir):
    path = f"{tmp_dir}/odd.gpkg"
    curve = struct.pack("<BI", 1, 8) + struct.pack("<I", 0)                  # a circular string
    point = Q.encode_gpkg_geometry("Point", [[[(1.0, 2.0)]]])
    mixed = Q.encode_gpkg_geometry("GeometryCollection:Point,LineString", [[[(1.0, 2.0)]], [[(0.0, 0.0), (3.0, 4.0)]]])
    with sqlite3.connect(path) as con:
        con.executescript("""CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT);
            CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT);
            INSERT INTO gpkg_contents VALUES ('t', 'features'); INSERT INTO gpkg_geometry_columns VALUES ('t', 'geometry');
            CREATE TABLE t (fid INTEGER PRIMARY KEY, n INTEGER, w REAL, s TEXT, b BOOLEAN, raw BLOB, geometry BLOB)""")
        con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?, ?)", [
            (1, 2 ** 60 + 1, 1, "é", 1, b"\x00\xff", point), (2, "text", "x", 5, None, None, curve), (3, 1.5, None, None, 0, b"", point[:-3]),
            (4, None, 2.5, "", 1, None, mixed), (5, 7, 7.0, "z", 0, None, None)])
    got = {r["fid"]: r for r in Q.read_features(spark, path).collect()}
    assert (got[1]["n"], got[1]["w"], got[1]["s"], got[1]["b"], got[1]["raw"]) == (2 ** 60 + 1, 1.0, "é", True, b"\x00\xff")
    assert (got[2]["n"], got[2]["w"], got[2]["s"], got[2]["geometry"]) == (None, None, "5", None)
    assert (got[3]["n"], got[3]["geometry"], got[5]["geometry"]) == (None, None, None)
    assert got[1]["geometry"]["kind"] == "Point" and got[4]["geometry"]["kind"] == "GeometryCollection:Point,LineString"
    wkt = Q.read_features(spark, path).where("fid = 4").select(G.to_wkt("geometry")).first()[0]
    assert wkt == "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 3 4))"
    with pytest.raises(Exception, match="no column nope"):
        Q.read_features(spark, path, columns=["fid", "nope"]).collect()
