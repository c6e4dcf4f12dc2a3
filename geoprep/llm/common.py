"""Helpers shared by the operators of this package."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from geoprep.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_scopes = threading.local()


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: later
    steps read columns of it, and a lost executor costs a re-read.  Inside ``scratch()`` the
    folder goes when that ends, unless ``keep``."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    for open_ in getattr(_scopes, "open", [])[-1:]:
        if not keep:
            open_.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch():
    """Tables staged inside, but for those to keep, are removed at the end: what leaves the
    block may only read kept ones."""
    stack = _scopes.__dict__.setdefault("open", [])
    stack.append([])
    try:
        yield
    finally:
        for spark, path in stack.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def slices(batches, column: str = "text", chars: int = 1 << 21):
    """The frames of ``batches`` in runs of rows with about ``chars`` characters in
    ``column`` (one row at least), so that what a task holds is bounded by that and its
    longest row."""
    for pdf in batches:
        sizes = [len(x) if isinstance(x, str) else 0 for x in pdf[column]]
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > chars:
                yield pdf.iloc[start:i]
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield pdf.iloc[start:]


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the bytes of an Arrow batch in this session to ``BATCH_BYTES``: both the JVM and
    the Python worker hold whole batches of each task, and texts make large ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, None)
    if held is None or not held.rstrip("b").isdigit() or int(held.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


#: Rows of a side that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (staged, narrow rows) with a broadcast hint if it counts at most ``rows`` rows."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= rows else df
