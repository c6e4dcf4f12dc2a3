"""Chunked incremental postal load.

The studied loader pages through the joined gazetteer with LIMIT/OFFSET, enriches each
chunk and appends it to a table partitioned by country, state and city, stopping at the
first empty chunk (or after the first in test mode).  Here:

1. the joined records are written once as files of at most ``chunk_rows`` rows
   (``stage_records``) -- a fixed cut, so a restart sees the same chunks;
2. a Structured Streaming file source reads them with ``maxFilesPerTrigger`` and
   ``trigger(availableNow=True)``: the query ends by itself when the files are used up (T3), and
   its checkpoint (in the shared checkpoint folder) lets a failed run resume at the first
   unfinished micro-batch, which the studied loader cannot;
3. a micro-batch holds as many chunks as make ``MICRO_BATCHES`` of a load: each one starts a fixed
   number of jobs and reads the whole boundary index, so one per chunk would cost chunks x
   boundaries.  ``foreachBatch`` enriches its chunks with the same code as the one-shot job and
   writes them (K3).  ``max_chunks`` limits the run to that many chunks (T2).
4. ``foreachBatch`` is at-least-once, so the write is one that may be repeated: the table's
   first partition column, ``load_chunk``, names the staged file a row came from.  Chunks are
   written under ``_staging`` and each is then moved, by one rename of its folder, in place of
   what the table holds of it.  A run killed anywhere, after the write too, leaves each chunk once
   when it is run again.  File names hold the id of the staging job, so another load adds to the
   table.  A marker under ``_chunks/<load id>``, written after the move, only spares complete
   chunks the work; nothing rests on it.  Readers ignore ``_``-prefixed folders.
5. ``max_chunks`` stops the run by failing a micro-batch before it is committed, so a later run
   goes on with the chunks left.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geoprep.operators.postal import boundary_index, enrich_records
from geoprep.session import ensure_checkpoint_dir
from geoprep.sources.tables import path_exists, publish_partitions, write_table
from geoprep.spec import POSTAL_CHUNK_ROWS, POSTAL_PARTITIONS


def stage_records(records: DataFrame, path: str, chunk_rows: int = POSTAL_CHUNK_ROWS) -> str:
    """Write the joined records in id order as files of about ``chunk_rows`` rows (at most
    that many): one range partition per chunk, sized from the record count."""
    n = records.count()
    parts = max(1, -(-n // chunk_rows))
    (records.repartitionByRange(parts, "id")
            .sortWithinPartitions("id")
            .write.mode("overwrite").option("maxRecordsPerFile", chunk_rows).parquet(path))
    return path


class _Enough(Exception):
    """Raised inside a micro-batch to stop before it is committed."""


def staged_files(spark: SparkSession, records_path: str) -> list:
    return sorted(f.rsplit("/", 1)[-1] for f in spark.read.parquet(records_path).inputFiles())


def load_identity(spark: SparkSession, records_path: str) -> str:
    """A name for the load of these staged files (their names hold the staging job's id)."""
    return hashlib.sha256("\n".join(staged_files(spark, records_path)).encode()).hexdigest()[:16]


CHUNK_COLUMN = "load_chunk"
MICRO_BATCHES = 4                 # of a whole load, however many chunks it has


def chunked_load(spark: SparkSession, records_path: str, adm1: DataFrame, adm2: DataFrame, target: str, *,
                 files_per_chunk: int = 1, max_chunks: int | None = None, checkpoint: str | None = None,
                 load_id: str | None = None, partition_by=POSTAL_PARTITIONS, stage_mode: str | None = "checkpoint") -> dict:
    """Run the incremental load; returns {'chunks': n, 'rows': written rows}."""
    load_id = load_id or load_identity(spark, records_path)
    place = hashlib.sha256(f"{target.rstrip('/')}|{load_id}".encode()).hexdigest()[:16]
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/postal-load-{place}"
    markers = f"{target.rstrip('/')}/_chunks/{load_id}"
    schema = spark.read.parquet(records_path).schema
    chunks = -(-len(staged_files(spark, records_path)) // files_per_chunk)
    at_once = max(1, min(-(-chunks // MICRO_BATCHES), max_chunks or chunks))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_chunk * at_once)
              .parquet(records_path))
    stats = {"chunks": 0, "rows": 0}
    index = boundary_index(adm1, adm2, stage_mode=stage_mode)   # static side: prepared once

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("__file", F.element_at(F.split(F.input_file_name(), "/"), -1))
        files = sorted(r[0] for r in named.select("__file").distinct().collect())    # at_once * files_per_chunk names
        if path_exists(spark, markers):       # replayed files that are complete
            done = spark.read.schema("file string").json(f"{markers}/*").where(F.col("file").isin(files))
            files = sorted(set(files) - {r[0] for r in done.distinct().collect()})
        if not files:
            return
        room = None if max_chunks is None else (max_chunks - stats["chunks"]) * files_per_chunk
        if room == 0:
            raise _Enough("max_chunks reached")
        now = files[:room]
        chunk = named.where(F.col("__file").isin(now)).withColumnRenamed("__file", CHUNK_COLUMN)
        out = enrich_records(chunk, stage_mode=stage_mode, index=index, keep=(CHUNK_COLUMN,))
        obs = Observation(f"chunks_{batch_id}_{uuid.uuid4().hex[:8]}")
        staging = f"{target.rstrip('/')}/_staging/{uuid.uuid4().hex}"
        write_table(out, staging, partition_by=(CHUNK_COLUMN, *partition_by), deal_by=(CHUNK_COLUMN, *partition_by[:-1]),
                    observe=(obs, [F.count(F.lit(1)).alias("rows")]))
        publish_partitions(spark, staging, target)
        spark.createDataFrame([(f,) for f in now], "file string").coalesce(1) \
            .write.mode("overwrite").json(f"{markers}/{uuid.uuid4().hex}")
        stats["chunks"] += -(-len(now) // files_per_chunk)
        stats["rows"] += int(obs.get["rows"])
        if len(now) < len(files):
            raise _Enough("max_chunks reached")

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except StreamingQueryException as e:
        if "_Enough" not in str(e):
            raise
    return stats


def first_chunk(records: DataFrame, chunk_rows: int = POSTAL_CHUNK_ROWS) -> DataFrame:
    """Test mode (T2): only the first chunk, in id order (the limit is the feature)."""
    return records.orderBy("id").limit(chunk_rows)
