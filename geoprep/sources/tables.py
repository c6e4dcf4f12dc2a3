"""Table sources and sinks.

The table format is a parameter (Parquet by default; a lakehouse format whose jars are on
the cluster's classpath works the same way through ``format``).  Paths are plain URIs
resolved through the Hadoop file system of the session.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoprep.functions.text import empty_to_null
from geoprep.operators.keyed import split_rejects, upsert, write_report
from geoprep.operators.stage import stage, stage_table
from geoprep.sources.folders import can_write, read_folders, write_folders

WRITE_MODES = ("overwrite", "append")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop FS API (local, HDFS, object stores alike)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_table(spark: SparkSession, path: str, *, fmt: str = "parquet", columns=None, where=None,
               schema=None, options: dict | None = None) -> DataFrame:
    """Lazy table scan (S4, S5); ``columns`` and ``where`` are pruned/pushed into the scan
    by Catalyst (S6, F5: a filter on a partition column prunes directories)."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    with _few_listing_tasks(spark):
        df = reader.load(path)
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*columns)
    return df


def load_or_skip(spark: SparkSession, path: str, **kw):
    """(DataFrame or None, report row): a source that is missing or is no table of its format
    is skipped with a reason instead of failing the job (S2).  Other faults (permissions, the
    network, a bad option) are raised."""
    if not path_exists(spark, path):
        return None, {"path": path, "status": "skipped", "reason": "not found"}
    try:
        df = read_table(spark, path, **kw)
        df.schema  # resolve now: unreadable files fail here, not in a later stage
    except AnalysisException as e:
        return None, {"path": path, "status": "skipped", "reason": f"unreadable: {e.getCondition()}"}
    except Exception as e:
        if "CANNOT_READ_FILE_FOOTER" not in str(e) and "is not a Parquet file" not in str(e):
            raise
        return None, {"path": path, "status": "skipped", "reason": "unreadable: not a table of its format"}
    return df, {"path": path, "status": "loaded", "reason": None}


def prepare_for_write(df: DataFrame, partition_by=(), *, partitions: int | None = None, deal_by=None) -> DataFrame:
    """Partition values: '' -> null (both land in the default partition and read back as
    null -- made explicit).  Rows are dealt by a hash of the partition columns, so each task
    writes few directories; the input is computed once (no sampling for range bounds).

    Without ``partitions`` the tasks are cut and merged by their measured sizes (a rebalance:
    a partition value holding a third of all rows becomes several tasks and files, small ones
    share a task); with it, a hash of the row spreads every value over that many tasks (K10), and a
    table without partition columns is dealt evenly over them.  ``deal_by`` names the leading
    partition columns to deal by, so that one task makes all folders below a value of theirs."""
    partition_by = list(partition_by)
    if not set(deal_by or ()) <= set(partition_by):
        raise ValueError("deal_by must name partition columns")
    if not partition_by:
        return df.repartition(partitions) if partitions else df
    df = df.withColumns({c: empty_to_null(c) for c in partition_by if dict(df.dtypes)[c] == "string"})
    cols = [F.col(c) for c in deal_by or partition_by]
    if partitions:
        return df.repartition(partitions, *cols, F.pmod(F.xxhash64(*df.columns), F.lit(partitions)))
    return df.hint("rebalance", *cols)


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by=(), fmt: str = "parquet",
                skip_empty: bool = False, partitions: int | None = None,
                options: dict | None = None, observe: tuple | None = None, replace_partitions: bool = False, deal_by=None) -> bool:
    """Write a (partitioned) table (K1, K2, K3).  ``mode`` must be 'overwrite' or 'append'
    (anything else raises, as the studied writer does); overwrite replaces the table
    (static partition overwrite, Spark's default).  Errors are raised, not swallowed
    (Q21).  With ``skip_empty`` an empty frame writes nothing (K14).  Returns whether
    anything was written.  ``replace_partitions`` overwrites only the partitions that ``df`` has
    rows for (dynamic partition overwrite): the same write repeated changes nothing, and the
    files of other partitions stay as they are.  ``observe`` = (Observation, [metric columns]) counts what is written.
    ``deal_by``: see ``prepare_for_write``; it marks a table of very many small folders, which is
    written by ``geoprep.sources.folders`` where that can."""
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}; known: {', '.join(sorted(WRITE_MODES))}")
    if replace_partitions and not partition_by:
        raise ValueError("replace_partitions needs partition columns")
    if skip_empty and df.isEmpty():
        return False
    out = prepare_for_write(df, partition_by, partitions=partitions, deal_by=deal_by)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    if deal_by and fmt == "parquet" and not (options or replace_partitions) and can_write(out, path, partition_by):
        with _all_cores(df.sparkSession):
            write_folders(out, path, partition_by, mode=mode)
        return True
    w = out.write.format(fmt).mode("overwrite" if replace_partitions else mode).options(**(options or {}))
    if replace_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with _all_cores(df.sparkSession):
        w.save(path)
    return True


def _all_cores(spark: SparkSession):
    """While a partitioned table is written its rebalance merges tasks down to one per core, not
    by size alone: what a small file costs is its creation, so a few MB in thousands of
    partition values must not end up in one or two tasks."""
    return _setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")


def _few_listing_tasks(spark: SparkSession):
    """While a table is opened its folders are listed by a few tasks a core, not by one task a
    folder (up to 10,000), which costs more than the listing."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    return _setting(spark, key, str(min(int(spark.conf.get(key, "10000")), 4 * spark.sparkContext.defaultParallelism)))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def publish_partitions(spark: SparkSession, staged: str, path: str) -> int:
    """Move the top partition folders of the table at ``staged`` (same file system) to the table at
    ``path``, each in place of its namesake and by one rename; removes ``staged``.  Returns how many.

    Repeating a write and its publication changes nothing, whatever was there of it before."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    src = folder(staged)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    moved = 0
    for status in fs.listStatus(src):
        part = status.getPath()
        if status.isDirectory() and not part.getName().startswith(("_", ".")):
            to = folder(path, part.getName())
            fs.delete(to, True)
            if not fs.rename(part, to):
                raise OSError(f"cannot move {part.toString()} to {to.toString()}")
            moved += 1
    fs.delete(src, True)
    return moved


def write_keyed(df: DataFrame, path: str, keys, *, table: str, rejects_path: str | None = None, **write) -> DataFrame:
    """Write the rows of ``df`` whose key is whole, those with a null key part to ``rejects_path``
    (if given, with their reason), and return the report (table, outcome, reason, rows) (K11).

    ``df`` is computed once, into the shared checkpoint folder; both writes and the counts read
    that copy.  Counts taken during a write would count a task twice that runs again after a lost
    executor.  ``write`` goes to ``write_table`` (mode, partition_by, partitions, ...)."""
    rows = stage(df, "checkpoint")
    accepted, rejected = split_rejects(rows, keys)
    write_table(accepted, path, **write)
    if rejects_path is not None:
        write_table(rejected, rejects_path, mode=write.get("mode", "overwrite"), fmt=write.get("fmt", "parquet"))
    return write_report(table, rows, keys)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", sep: str = ",") -> None:
    """Plain-text dump with a header (K4)."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def read_back(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet", partition_by=None) -> DataFrame:
    """Read a written table with the writer's schema (partition columns keep their type
    instead of being inferred from directory names), columns in the writer's order.
    ``partition_by``, for a table of very many folders, takes those columns from the file paths
    (``read_folders``)."""
    if partition_by:
        with _few_listing_tasks(spark):
            return read_folders(spark, path, like.schema, partition_by, fmt)
    return read_table(spark, path, fmt=fmt, schema=like.schema, columns=like.columns)


def read_stored(spark: SparkSession, path: str, partition_types: DataFrame, partition_by, fmt: str = "parquet") -> DataFrame:
    """A stored table with all columns it has; partition columns get their type from
    ``partition_types`` instead of being guessed from directory names."""
    found = spark.read.format(fmt).load(path).schema
    types = {f.name: f.dataType for f in partition_types.schema.fields}
    schema = T.StructType([T.StructField(f.name, types[f.name] if f.name in partition_by else f.dataType) for f in found.fields])
    return spark.read.format(fmt).schema(schema).load(path)


def merge_table(spark: SparkSession, batch: DataFrame, path: str, keys, order_by, *, partition_by, fmt: str = "parquet") -> DataFrame:
    """Upsert ``batch`` into the stored table at ``path``, touching only the partitions it has
    rows for (K5, K6, W5); returns the rejects (null key parts).

    The partition columns must belong to the key, so a row cannot leave its partition.  The
    batch's partition values (at most the table's directories) prune the scan of the target;
    the merged partitions are staged and then replace the old ones.  A crash before that leaves
    the table as it was, one during it leaves some partitions old and some new, and the same
    batch again completes it: an upsert repeated changes nothing.  A table that is not there
    yet, and one whose folder holds no files, is created."""
    keys, partition_by = list(keys), list(partition_by)
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    batch = stage(batch, "checkpoint")                        # the key check, the values and the merge read it
    accepted, rejected = split_rejects(batch, keys)
    target = accepted.limit(0)
    if path_exists(spark, path) and _holds_files(spark, path):
        touched = [[r[c] for r in accepted.select(c).distinct().collect()] for c in partition_by]
        stored = read_stored(spark, path, batch, partition_by, fmt)
        # values per column prune directories; the semi join keeps the combinations that occur
        pruned = reduce(lambda a, b: a & b, [F.col(c).isin(v) for c, v in zip(partition_by, touched)])
        target = stored.where(pruned).join(accepted.select(*partition_by).distinct(), partition_by, "left_semi").select(*stored.columns)
    table, _ = upsert(target, accepted, keys, order_by)
    write_table(stage_table(table, "merged"), path, replace_partitions=True, partition_by=partition_by, fmt=fmt)
    return rejected


def _holds_files(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(place, True).hasNext()
