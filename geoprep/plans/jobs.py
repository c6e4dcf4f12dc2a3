"""User-level jobs.

Each job is a short driver program that declares DataFrames and writes them; the work
itself runs in the executors.  The per-level report (rows, MB, seconds) is gathered with
an observation on the write, so it costs no second pass over the data.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geoprep.operators.boundary import prepare_level
from geoprep.operators.keyed import split_rejects, upsert
from geoprep.operators.profile import load_report, profile_metrics
from geoprep.sources.tables import merge_table, path_exists, read_back, read_table, write_table
from geoprep.spec import LEVELS, POSTAL_COLUMNS, POSTAL_KEY


def load_boundaries(spark: SparkSession, path: str, *, table: str | None = None, cache=None,
                    columns=None):
    """Boundary features of one level (S1, S2, C1, C2): the cached frame when the cache
    holds a fresh one under ``gadm_<path>``, else the file read (GeoPackage/SQLite through
    the gpkg source, anything else through ``spark.read``) and stored in the cache; a
    missing source gives None (the level is skipped)."""
    from geoprep.sources.sqlite import read_features

    key = f"gadm_{path}"
    if cache is not None:
        hit = cache.get(key)
        if hit is not None:
            return hit
    local = path[len("file:"):] if path.startswith("file:") else path
    if not path_exists(spark, path):
        return None
    if local.endswith((".gpkg", ".sqlite", ".db")) or _has_feature_files(local):
        df = read_features(spark, local, table=table, columns=columns)
    else:
        df = read_table(spark, path, columns=columns)
    return cache.set(key, df) if cache is not None else df


def _has_feature_files(path: str) -> bool:
    import glob
    import os

    return os.path.isdir(path) and bool(glob.glob(os.path.join(path, "*.gpkg")))


def run_level(spark: SparkSession, raw: DataFrame | None, level: str, out_root: str, *, fmt: str = "parquet",
              store_root: str | None = None, **prepare_kw) -> dict:
    """Prepare one level, write it partitioned per its spec, report rows/MB/seconds, and
    with ``store_root`` upsert the written rows into the level's keyed table there.
    A missing source (``raw is None``) is skipped with a report line (S2)."""
    spec = LEVELS[level]
    path = f"{out_root.rstrip('/')}/{spec.table}"
    if raw is None:
        return {"level": level, "table": spec.table, "path": path, "status": "skipped"}
    t = time.perf_counter()
    df = prepare_level(raw, spec, **prepare_kw)
    obs = Observation(f"profile_{level}_{uuid.uuid4().hex[:8]}")
    # observed on the write itself (after its range partitioning): no second pass
    write_table(df, path, mode="overwrite", partition_by=spec.partition_by, fmt=fmt,
                observe=(obs, profile_metrics(df)))
    m = obs.get
    rep = load_report(level, m["rows"], m["bytes"], time.perf_counter() - t)
    rep.update({"table": spec.table, "path": path, "status": "written"})
    if store_root is not None:
        rep.update(store_level(spark, read_back(spark, path, df, fmt), level, store_root, fmt=fmt))
    return rep


def run_all_levels(spark: SparkSession, raws: dict, out_root: str, **kw) -> list:
    """Every level in turn."""
    return [run_level(spark, raws.get(level), level, out_root, **kw) for level in LEVELS]


def serve_postal(spark: SparkSession, postal_path: str, target: DataFrame | None = None):
    """Postal table (S4) -> keyed serving table (K6): upsert on
    ((country, state, city), postal_code); rows with a null key part go to the rejects."""
    rows = read_table(spark, postal_path).select(*POSTAL_COLUMNS)
    base = target if target is not None else rows.limit(0)
    return upsert(base, rows, list(POSTAL_KEY), ["wkt_geometry", "lat", "lon"])


def store_postal(spark: SparkSession, postal_path: str, out_root: str, *, fmt: str = "parquet") -> None:
    """W5 on stored tables: the postal rows are upserted into ``wof_data`` as it stands (a
    second batch adds to the first); only the countries that occur in them are rewritten.  The
    rejects go to ``wof_data_rejects`` under the name of their batch, once however often it is run."""
    path = f"{out_root.rstrip('/')}/wof_data"
    rows = read_table(spark, postal_path).select(*POSTAL_COLUMNS)
    rejected = merge_table(spark, rows, path, list(POSTAL_KEY), ["wkt_geometry", "lat", "lon"], partition_by=("country",), fmt=fmt)
    _keep_rejects(rejected, rows, f"{path}_rejects", fmt)


def _keep_rejects(rejected: DataFrame, batch: DataFrame, path: str, fmt: str) -> None:
    """Rejected rows under ``batch=<name>``, where the name comes from the batch's files."""
    name = hashlib.sha256("\n".join(sorted(batch.inputFiles())).encode()).hexdigest()[:16]
    write_table(rejected.withColumn("batch", F.lit(name)), path, replace_partitions=True, partition_by=("batch",), fmt=fmt, skip_empty=True)


def store_level(spark: SparkSession, prepared: DataFrame, level: str, store_root: str, *, fmt: str = "parquet") -> dict:
    """The store step of W1: the prepared rows of a level upserted into its keyed table, the
    row last by shapeID winning; rows with a null key part go to the rejects."""
    spec = LEVELS[level]
    path = f"{store_root.rstrip('/')}/{spec.table}"
    columns = [c for c in prepared.columns if c != "geometry"]
    rejected = merge_table(spark, prepared.select(*columns), path, list(spec.key), ["shapeID"], partition_by=("country_code",), fmt=fmt)
    _keep_rejects(rejected, prepared, f"{path}_rejects", fmt)
    return {"level": level, "stored": path, "rejected": rejected.count()}


def run_parallel(jobs: dict, max_workers: int | None = None) -> dict:
    """Independent Spark jobs submitted concurrently from one driver; the scheduler
    shares the executors between them.  Returns {name: seconds}; a failure is raised."""
    def timed(fn):
        t = time.perf_counter()
        fn()
        return time.perf_counter() - t

    with ThreadPoolExecutor(max_workers=max_workers or len(jobs)) as pool:
        futures = {name: pool.submit(timed, fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


__all__ = ["load_boundaries", "run_level", "run_all_levels", "serve_postal", "store_postal", "store_level", "run_parallel", "split_rejects"]
