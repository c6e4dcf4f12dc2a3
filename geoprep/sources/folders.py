"""Tables of very many small partition folders: Parquet writes on a file system of plain paths, and reads.

Without Hadoop's native library its local file system starts a ``chmod`` process for every new
folder, file and checksum file, so a table of country, state and city costs processes, not
rows.  Here each task writes its sorted rows through Arrow, one file at a time, into a staging
folder of its attempt.  A task's result names that folder, and Spark takes the result of one
attempt only; the driver then moves those folders into the table by renames, whole trees where the
table has none of that name.  Attempts that failed leave nothing.  Names of folders, types
and null partitions are those of Spark's own writer, which stays in charge of every other file
system, format and type (``can_write``).

Spark's partition discovery takes, on the driver, a time that grows with the square of the number of
folders.  ``read_folders`` takes the values from each row's file path instead; a filter on them
still leaves out files before they are opened, as one on ``_metadata`` does.
"""

from __future__ import annotations

import errno
import os
import shutil
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAT = {"string", "tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz", "binary"}
CODECS = {"none", "uncompressed", "snappy", "gzip", "zstd"}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ROW_GROUP_BYTES = 64 << 20
_ESCAPED = {c: f"%{c:02X}" for c in (*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^"))}


def local_place(spark: SparkSession, path: str) -> str | None:
    """The plain path of ``path`` on the file system of plain paths (``file:``), else None."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def can_write(df: DataFrame, path: str, partition_by) -> bool:
    spark, fields = df.sparkSession, df.schema.fields
    names = {f.name for f in fields}
    return (set(partition_by) < names and len({n.lower() for n in names}) == len(fields)
            and all(f.dataType.simpleString() in FLAT for f in fields)
            and _codec(spark) in CODECS and int(spark.conf.get("spark.sql.files.maxRecordsPerFile", "0")) <= 0
            and local_place(spark, path) is not None)


def write_folders(df: DataFrame, path: str, partition_by, *, mode: str = "append") -> int:
    """Write ``df`` (already dealt to tasks) below ``path``, one file per task and partition folder;
    'overwrite' replaces the table once all rows are staged.  Returns the rows written."""
    spark, keys = df.sparkSession, list(partition_by)
    rest = [c for c in df.columns if c not in keys]
    place = local_place(spark, path)
    staging = os.path.join(place, f"_temporary-{uuid.uuid4().hex}")
    os.makedirs(staging)
    try:
        rows = df.select(*rest, *[F.col(c).cast("string").alias(f"__folder_{i}") for i, c in enumerate(keys)])
        rows = rows.sortWithinPartitions(*[f"__folder_{i}" for i in range(len(keys))])
        metadata = {"org.apache.spark.version": spark.version,
                    "org.apache.spark.sql.parquet.row.metadata": T.StructType([df.schema[c] for c in rest]).json()}
        # bounds of doubles leave NaN out here, and Spark would skip its rows by them
        bounded = [c for c in rest if df.schema[c].dataType.simpleString() not in ("float", "double")]
        done = rows.mapInArrow(_task(staging, keys, rest, _codec(spark), metadata, bounded), "folder string, rows long").collect()
        if mode == "overwrite":
            for name in os.listdir(place):
                if name != os.path.basename(staging):
                    _remove(os.path.join(place, name))
        for r in done:
            _move(r.folder, place)
        open(os.path.join(place, "_SUCCESS"), "wb").close()
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    return sum(r.rows for r in done)


def read_folders(spark: SparkSession, path: str, schema: T.StructType, partition_by, fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` with the columns of ``schema``; those of ``partition_by`` come from the folder names."""
    data = T.StructType([f for f in schema.fields if f.name not in partition_by])
    df = spark.read.format(fmt).schema(data).option("recursiveFileLookup", "true").load(path)

    def decoded(text):                           # a plus sign is no space here
        return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)

    def value(f):                                # the path is that of a URI, the folder's name in it is escaped by the writer
        text = F.regexp_extract(decoded(F.col("_metadata.file_path")), rf".*/\Q{f.name.translate(_ESCAPED)}\E=([^/]*)/", 1)
        return decoded(F.when(~text.isin("", NULL_FOLDER), text)).cast(f.dataType).alias(f.name)

    return df.select(*[value(f) if f.name in partition_by else F.col(f.name) for f in schema.fields])


def _codec(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.parquet.compression.codec", "snappy").lower()


def _task(staging: str, keys: list, rest: list, codec: str, metadata: dict, bounded: list):
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        mine = uuid.uuid4().hex
        place, name = os.path.join(staging, mine), f"part-{TaskContext.get().partitionId():05d}-{mine}.parquet"
        at, file, n = None, None, 0
        for batch in batches:
            for values, rows in _runs(batch, len(keys), rest):
                if values != at:
                    if file:
                        file.close()
                    folder = os.path.join(place, *[f"{k.translate(_ESCAPED)}={v.translate(_ESCAPED) if v else NULL_FOLDER}" for k, v in zip(keys, values)])
                    os.makedirs(folder, exist_ok=True)
                    at, file = values, _File(os.path.join(folder, name), rows.schema, codec, metadata, bounded)
                file.add(rows)
                n += rows.num_rows
        if file:
            file.close()
            yield pa.RecordBatch.from_pydict({"folder": [place], "rows": [n]})

    return write


def _runs(batch, n_keys: int, rest: list) -> Iterator:
    """(folder values, rows) for each stretch of rows of one folder."""
    import numpy as np

    if not batch.num_rows:
        return
    columns = [batch.column(f"__folder_{i}") for i in range(n_keys)]
    starts = np.ones(batch.num_rows, bool)
    starts[1:] = False
    for c in columns:
        codes = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        starts[1:] |= codes[1:] != codes[:-1]
    at, rows = [*np.flatnonzero(starts).tolist(), batch.num_rows], batch.select(rest)
    for a, b in zip(at, at[1:]):
        yield tuple(c[a].as_py() for c in columns), rows.slice(a, b - a)


class _File:
    """A Parquet file of row groups of about ``ROW_GROUP_BYTES``."""

    def __init__(self, path: str, schema, codec: str, metadata: dict, bounded: list):
        import pyarrow as pa
        import pyarrow.parquet as pq

        self.schema, self.held, self.size = schema, [], 0
        self.sink = pa.OSFile(path, "wb")
        self.writer = pq.ParquetWriter(self.sink, schema, compression="none" if codec == "uncompressed" else codec,
                                       store_schema=False, write_statistics=bounded or False)
        self.writer.add_key_value_metadata(metadata)

    def add(self, rows) -> None:
        self.held.append(rows)
        self.size += rows.nbytes
        if self.size >= ROW_GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        import pyarrow as pa

        self.writer.write_table(pa.Table.from_batches(self.held, self.schema))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        self.writer.close()
        self.sink.close()


def _move(src: str, to: str) -> None:
    """Move a tree into another, by one rename where that has no (or an empty) folder of its name."""
    try:
        os.rename(src, to)
    except OSError as e:
        if e.errno not in (errno.ENOTEMPTY, errno.EEXIST):
            raise
        for name in os.listdir(src):
            _move(os.path.join(src, name), os.path.join(to, name))


def _remove(path: str) -> None:
    if os.path.isdir(path) and not os.path.islink(path):
        shutil.rmtree(path)
    else:
        os.remove(path)
