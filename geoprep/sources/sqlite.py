"""GeoPackage / SQLite feature tables as a Spark data source.

A GeoPackage is a SQLite file whose geometry column holds a small header followed by
WKB.  The source registers as ``format("gpkg")`` and reads one or many files:

* planning (driver): table schema and rowid bounds per file -- metadata only;
* one input partition per ``rows_per_partition`` rowids of a file, read in the executors
  with the standard-library ``sqlite3`` in read-only mode;
* the geometry blob is decoded to the library's geometry struct in the same read, ring by
  ring into arrays, and rows leave the source as Arrow record batches;
* a box (``box`` option) keeps features whose own box meets it: the file's R-tree table says
  which rowid ranges are planned and which rows are read, a file without one is filtered row
  by row; comparisons on plain columns are pushed into the SQL where Spark offers them
  (``spark.sql.python.filterPushdown.enabled``), and Spark checks them again.

Options: ``table`` (default: the first feature table), ``columns`` (comma list: a read
projection -- Python sources get no automatic pruning; an unknown name raises),
``rows_per_partition`` (default 50000), ``box`` (xmin,ymin,xmax,ymax).  Paths must be files
the executors can open (a shared mount).

A geometry of a type beyond the seven of the standard, and a broken blob, are null.  Values
that are not of their column's declared type (SQLite allows them) are converted where that
loses nothing and null otherwise.

``write_feature_files`` writes each partition of a DataFrame as its own GeoPackage file;
it exists to derive GeoPackage inputs from other tables (tests, fixtures).
"""

from __future__ import annotations

import glob
import json
import os
import sqlite3
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from geoprep.functions.geometry import COLLECTION, GEOM

_KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: COLLECTION}
_CODES = {v: k for k, v in _KINDS.items()}


# ---------------------------------------------------------------------------------------
# WKB (2-D; Z/M ordinates are dropped)


class _Unsupported(ValueError):
    """A geometry type outside the standard's seven."""


def _read_wkb(buf: bytes, pos: int = 0):
    """-> (kind, parts as lists of rings as n x 2 arrays, next position)."""
    bo = "<" if buf[pos] == 1 else ">"
    (code,) = struct.unpack_from(bo + "I", buf, pos + 1)
    pos += 5
    dims = 2
    if code & 0x80000000 or code & 0x40000000:          # EWKB Z / M flags
        dims += bool(code & 0x80000000) + bool(code & 0x40000000)
        if code & 0x20000000:                            # EWKB SRID
            pos += 4
        code &= 0x0FFFFFFF
    elif code > 1000:                                    # ISO Z (1000), M (2000), ZM (3000)
        dims += {1: 1, 2: 1, 3: 2}.get(code // 1000, 0)
        code %= 1000
    kind = _KINDS.get(code)
    if kind is None:
        raise _Unsupported(code)

    def ring(n, p):
        end = p + 8 * dims * n
        if end > len(buf):
            raise _Unsupported("truncated")
        return np.frombuffer(buf, bo + "f8", dims * n, p).reshape(n, dims)[:, :2], end

    def count(p):
        return struct.unpack_from(bo + "I", buf, p)[0], p + 4

    if kind == "Point":
        xy, pos = ring(1, pos)
        return kind, [[xy]], pos
    n, pos = count(pos)
    if kind == "LineString":
        xy, pos = ring(n, pos)
        return kind, [[xy]], pos
    if kind == "Polygon":
        rings = []
        for _ in range(n):
            k, pos = count(pos)
            xy, pos = ring(k, pos)
            rings.append(xy)
        return kind, [rings], pos
    parts, kinds = [], []
    for _ in range(n):
        sub, more, pos = _read_wkb(buf, pos)
        parts.extend(more)
        kinds += part_kinds(sub, len(more))
    return (f"{COLLECTION}:{','.join(kinds)}" if kind == COLLECTION else kind), parts, pos


def part_kinds(kind: str, n: int) -> list:
    """The kind of each of the n parts of a geometry."""
    return kind.split(":")[1].split(",") if kind.startswith(COLLECTION) else [kind.removeprefix("Multi")] * n


def _write_wkb(kind: str, parts) -> bytes:
    def ring_bytes(ring):
        return struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", x, y) for x, y in ring)

    def single(k, part):
        head = struct.pack("<BI", 1, _CODES[k])
        if k == "Point":
            x, y = part[0][0]
            return head + struct.pack("<dd", x, y)
        if k == "LineString":
            return head + ring_bytes(part[0])
        return head + struct.pack("<I", len(part)) + b"".join(ring_bytes(r) for r in part)

    if kind in ("Point", "LineString", "Polygon"):
        return single(kind, parts[0])
    if kind.startswith(COLLECTION):
        return struct.pack("<BII", 1, _CODES[COLLECTION], len(parts)) + b"".join(map(single, part_kinds(kind, len(parts)), parts))
    sub = {"MultiPoint": "Point", "MultiLineString": "LineString", "MultiPolygon": "Polygon"}[kind]
    return struct.pack("<BII", 1, _CODES[kind], len(parts)) + b"".join(single(sub, p) for p in parts)


def _decode(blob):
    """GeoPackage geometry blob (or plain WKB) -> (kind, parts of arrays), or None for a null or
    empty geometry, an unsupported type or a broken blob."""
    if blob is None:
        return None
    b = bytes(blob)
    offset = 0
    try:
        if b[:2] == b"GP":
            if b[3] & 0x10:                              # empty geometry
                return None
            offset = 8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[(b[3] >> 1) & 0x07]
        kind, parts, _ = _read_wkb(b, offset)
    except (_Unsupported, struct.error, IndexError, KeyError, ValueError):
        return None
    return (kind, parts) if parts else None


def decode_gpkg_geometry(blob):
    """GeoPackage geometry blob -> (kind, parts as nested lists) or None (see ``_decode``)."""
    g = _decode(blob)
    return g and (g[0], [[[tuple(v) for v in ring.tolist()] for ring in part] for part in g[1]])


def _arrow_geometries(decoded: list):
    """Decoded geometries -> an Arrow array of the geometry struct, without a Python object per vertex."""
    import pyarrow as pa

    found = [g for g in decoded if g is not None]
    rings = [ring for _, parts in found for part in parts for ring in part]
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))
    vertices = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, k], dtype="f8")) for k in (0, 1)], ["x", "y"])

    def lists(sizes, values):
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes, dtype="i8")].astype("i4")), values)

    per_ring = lists([len(r) for r in rings], vertices)
    per_part = lists([len(part) for _, parts in found for part in parts], per_ring)
    per_geom = lists([len(g[1]) if g else 0 for g in decoded], per_part)
    kinds = pa.array([g[0] if g else None for g in decoded], pa.string())
    return pa.StructArray.from_arrays([kinds, per_geom], ["kind", "parts"], mask=pa.array([g is None for g in decoded], pa.bool_()))


def encode_gpkg_geometry(kind: str, parts, srs_id: int = 4326) -> bytes:
    return b"GP" + bytes([0, 0x01]) + struct.pack("<i", srs_id) + _write_wkb(kind, parts)


# ---------------------------------------------------------------------------------------
# The data source

_SQL_TYPES = {"INTEGER": T.LongType(), "INT": T.LongType(), "BIGINT": T.LongType(), "MEDIUMINT": T.LongType(),
              "SMALLINT": T.LongType(), "TINYINT": T.LongType(), "REAL": T.DoubleType(), "DOUBLE": T.DoubleType(),
              "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType(), "BLOB": T.BinaryType()}


def _files(path: str) -> list:
    path = path[len("file:"):] if path.startswith("file:") else path
    if os.path.isdir(path):
        return sorted(glob.glob(os.path.join(path, "*.gpkg")) + glob.glob(os.path.join(path, "*.sqlite"))
                      + glob.glob(os.path.join(path, "*.db")))
    return sorted(glob.glob(path))


def _connect(path: str):
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _table_meta(con, table: str | None):
    cur = con.cursor()
    geom_cols = {}
    try:
        for t, c in cur.execute("SELECT table_name, column_name FROM gpkg_geometry_columns"):
            geom_cols.setdefault(t, c)
        if table is None:
            row = cur.execute("SELECT table_name FROM gpkg_contents "
                              "ORDER BY data_type <> 'features', table_name LIMIT 1").fetchone()
            table = row[0] if row else None
    except sqlite3.DatabaseError:
        pass
    if table is None:
        row = cur.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name LIMIT 1").fetchone()
        table = row[0]
    cols = [(r[1], (r[2] or "").upper()) for r in cur.execute(f'PRAGMA table_info("{table}")')]
    return table, cols, geom_cols.get(table)


class _Slice(InputPartition):
    def __init__(self, path, lo, hi):
        self.path, self.lo, self.hi = path, lo, hi


class GpkgDataSource(DataSource):
    @classmethod
    def name(cls):
        return "gpkg"

    def _meta(self):
        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(self.options["path"])
        with _connect(files[0]) as con:
            table, cols, gcol = _table_meta(con, self.options.get("table"))
        wanted = self.options.get("columns")
        if wanted:
            keep = [c.strip() for c in wanted.split(",")]
            unknown = [c for c in keep if c not in {name for name, _ in cols}]
            if unknown:
                raise ValueError(f"table {table} has no column {', '.join(unknown)}")
            cols = [c for c in cols if c[0] in keep]
        return files, table, cols, gcol

    def schema(self):
        _, _, cols, gcol = self._meta()
        fields = []
        for name, sqltype in cols:
            if name == gcol:
                fields.append(T.StructField(name, GEOM))
            else:
                base = sqltype.split("(")[0].strip()
                fields.append(T.StructField(name, _SQL_TYPES.get(base, T.StringType())))
        return T.StructType(fields)

    def reader(self, schema):
        return (GpkgPushdownReader if self.options.get("pushdown") == "true" else GpkgReader)(self, schema)


def _converted(values: list, kind) -> list:
    """SQLite values as those of a column type; what does not convert is null."""
    def one(v):
        if isinstance(kind, T.StringType):
            return v if isinstance(v, str) else str(v) if isinstance(v, (int, float)) else None
        if isinstance(kind, T.BinaryType):
            return v if isinstance(v, bytes) else v.encode() if isinstance(v, str) else None
        if not isinstance(v, (int, float)):
            return None
        if isinstance(kind, T.BooleanType):
            return bool(v)
        return float(v) if isinstance(kind, T.DoubleType) else int(v) if v == int(v) else None

    return [None if v is None else one(v) for v in values]


class GpkgReader(DataSourceReader):
    BATCH = 2048                        # rows of a record batch

    def __init__(self, source: GpkgDataSource, schema):
        self.files, self.table, _, self.gcol = source._meta()
        self.fields = list(schema.fields)
        self.rows = int(source.options.get("rows_per_partition", "50000"))
        box = source.options.get("box")
        self.box = tuple(float(v) for v in box.split(",")) if box else None
        if self.box and self.gcol is None:
            raise ValueError(f"table {self.table} has no geometry column for a box")
        self.terms, self.values = [], []

    def _where(self, con) -> tuple[str, list]:
        """SQL condition and values of the box (by the R-tree, if the file has one) and the filters."""
        terms, values = list(self.terms), list(self.values)
        index = f"rtree_{self.table}_{self.gcol}"
        if self.box and con.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (index,)).fetchone():
            x0, y0, x1, y1 = self.box
            terms.append(f'rowid IN (SELECT id FROM "{index}" WHERE minx <= ? AND maxx >= ? AND miny <= ? AND maxy >= ?)')
            values += [x1, x0, y1, y0]
        return "".join(f" AND {t}" for t in terms), values

    def partitions(self):
        out = []
        for f in self.files:
            with _connect(f) as con:
                lo, hi = con.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
                if lo is None:
                    continue
                wanted = range((hi - lo) // self.rows + 1)
                where, values = self._where(con)
                if "rtree_" in where:                    # only the ranges in which the box has rows
                    found = con.execute(f'SELECT DISTINCT (rowid - ?) / ? FROM "{self.table}" WHERE 1{where}', [lo, self.rows, *values])
                    wanted = sorted(r[0] for r in found)
            out += [_Slice(f, lo + k * self.rows, min(hi, lo + (k + 1) * self.rows - 1)) for k in wanted]
        return out or [_Slice(self.files[0], 1, 0)]

    def read(self, partition):
        import pyarrow as pa

        types = {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(), T.StringType: pa.string()}
        names = [f.name for f in self.fields]
        read = names + ([self.gcol] if self.box and self.gcol not in names else [])
        with _connect(partition.path) as con:
            where, values = self._where(con)
            cols = ", ".join(f'"{c}"' for c in read)
            cur = con.execute(f'SELECT {cols} FROM "{self.table}" WHERE rowid BETWEEN ? AND ?{where} ORDER BY rowid',
                              [partition.lo, partition.hi, *values])
            while rows := cur.fetchmany(self.BATCH):
                columns = dict(zip(read, map(list, zip(*rows))))
                if self.gcol in columns:
                    columns[self.gcol] = [_decode(b) for b in columns[self.gcol]]
                    if self.box:
                        keep = [_meets(g, self.box) for g in columns[self.gcol]]
                        columns = {c: [v for v, k in zip(vs, keep) if k] for c, vs in columns.items()}
                arrays = [_arrow_geometries(columns[f.name]) if f.name == self.gcol else
                          pa.array(_converted(columns[f.name], f.dataType), types[type(f.dataType)]) for f in self.fields]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


class GpkgPushdownReader(GpkgReader):
    """The reader where the session offers filters to Python sources (Spark refuses one that
    would take them elsewhere)."""

    def pushFilters(self, filters):
        """Comparisons of plain columns with literals go into the SQL; all are returned, so Spark
        evaluates them as well."""
        plain = {f.name for f in self.fields if isinstance(f.dataType, (T.LongType, T.DoubleType, T.StringType))}
        signs = {"EqualTo": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<", "LessThanOrEqual": "<="}
        for f in filters:
            kind, column = type(f).__name__, getattr(f, "attribute", ())
            if len(column) == 1 and column[0] in plain:
                name = f'"{column[0]}"'
                if kind in signs and isinstance(f.value, (int, float, str)):
                    self.terms.append(f"{name} {signs[kind]} ?")
                    self.values.append(f.value)
                elif kind == "In" and all(isinstance(v, (int, float, str)) for v in f.value) and len(f.value) <= 500:
                    self.terms.append(f"{name} IN ({', '.join('?' * len(f.value))})")
                    self.values += list(f.value)
                elif kind == "IsNotNull":
                    self.terms.append(f"{name} IS NOT NULL")
            yield f


def _meets(geometry, box) -> bool:
    """Whether the box of a decoded geometry meets ``box`` (both closed)."""
    if geometry is None:
        return False
    xy = np.concatenate([ring for part in geometry[1] for ring in part])
    (x0, y0), (x1, y1) = xy.min(0), xy.max(0)
    return bool(x0 <= box[2] and x1 >= box[0] and y0 <= box[3] and y1 >= box[1])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GpkgDataSource)


def read_features(spark: SparkSession, path: str, table: str | None = None, columns=None,
                  rows_per_partition: int | None = None, box=None) -> DataFrame:
    """Features of GeoPackage/SQLite files; ``box`` (xmin, ymin, xmax, ymax) keeps those whose own
    box meets it."""
    register(spark)
    r = spark.read.format("gpkg").option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    if table:
        r = r.option("table", table)
    if columns:
        r = r.option("columns", ",".join(columns))
    if rows_per_partition:
        r = r.option("rows_per_partition", str(rows_per_partition))
    if box is not None:
        r = r.option("box", ",".join(repr(float(v)) for v in box))
    return r.load(path)


# ---------------------------------------------------------------------------------------
# Writing feature files (to derive GeoPackage inputs from other tables)


def write_feature_files(df: DataFrame, directory: str, table: str, geometry_col: str = "geometry") -> DataFrame:
    """Each partition of ``df`` becomes ``part-<n>.gpkg`` in ``directory`` (a folder the
    executors can write, e.g. under the shared checkpoint folder).  Returns a frame of
    (path, rows) per file; nothing passes through the driver."""
    directory = directory[len("file:"):] if directory.startswith("file:") else directory
    attrs = [(f.name, f.dataType) for f in df.schema.fields if f.name != geometry_col]
    has_geom = geometry_col in df.columns
    if has_geom:   # ragged nested arrays do not convert to pandas; ship the geometry as JSON text
        from pyspark.sql import functions as F
        df = df.withColumn(geometry_col, F.to_json(F.col(geometry_col)))

    def sql_type(t):
        if isinstance(t, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
            return "INTEGER"
        if isinstance(t, (T.DoubleType, T.FloatType)):
            return "REAL"
        return "TEXT"

    def write(iterator):
        import uuid

        import pandas as pd
        from pyspark import TaskContext

        os.makedirs(directory, exist_ok=True)
        pid = TaskContext.get().partitionId()
        # write under a temporary name, then rename to the partition's fixed name: a retried
        # or speculative attempt replaces the file instead of leaving a second copy
        final = os.path.join(directory, f"part-{pid:05d}.gpkg")
        path = f"{final}.{uuid.uuid4().hex[:8]}.tmp"
        con = sqlite3.connect(path)
        cols_sql = ", ".join([f'"{n}" {sql_type(t)}' for n, t in attrs] + ([f'"{geometry_col}" BLOB'] if has_geom else []))
        data_type = "features" if has_geom else "attributes"
        con.executescript(f"""
            CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT,
                organization_coordsys_id INTEGER, definition TEXT, description TEXT);
            INSERT INTO gpkg_spatial_ref_sys VALUES ('WGS 84', 4326, 'EPSG', 4326, 'undefined', NULL);
            CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT,
                description TEXT, last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER);
            CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT,
                srs_id INTEGER, z INTEGER, m INTEGER);
            INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES ('{table}', '{data_type}', '{table}', 4326);
            CREATE TABLE "{table}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, {cols_sql});""")
        if has_geom:
            con.execute(f"INSERT INTO gpkg_geometry_columns VALUES ('{table}', '{geometry_col}', 'GEOMETRY', 4326, 0, 0)")
            index = f"rtree_{table}_{geometry_col}"
            con.execute(f'CREATE VIRTUAL TABLE "{index}" USING rtree(id, minx, maxx, miny, maxy)')
        names = [n for n, _ in attrs] + ([geometry_col] if has_geom else [])
        insert = f'INSERT INTO "{table}" ({", ".join(chr(34) + n + chr(34) for n in names)}) VALUES ({", ".join("?" * len(names))})'
        n = 0
        for pdf in iterator:
            rows, boxes = [], []
            for rec in pdf.to_dict("records"):
                vals = [None if (isinstance(rec[c], float) and pd.isna(rec[c])) else rec[c] for c, _ in attrs]
                if has_geom:
                    g = rec.get(geometry_col)
                    blob = None
                    if isinstance(g, str):
                        g = json.loads(g)
                        parts = [[[(v["x"], v["y"]) for v in ring] for ring in part] for part in g["parts"]]
                        blob = encode_gpkg_geometry(g["kind"], parts)
                        xs, ys = zip(*[v for part in parts for ring in part for v in ring])
                        boxes.append((n + len(rows) + 1, min(xs), max(xs), min(ys), max(ys)))
                    vals.append(blob)
                rows.append(vals)
            con.executemany(insert, rows)
            if boxes:
                con.executemany(f'INSERT INTO "{index}" VALUES (?, ?, ?, ?, ?)', boxes)
            n += len(rows)
        con.commit()
        con.close()
        os.replace(path, final)
        yield pd.DataFrame({"path": [final], "rows": [n]})

    return df.mapInPandas(write, "path string, rows long")
