"""Counts, previews, pages, lookups and load profiles."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``n`` = number of rows (A1, A3 with a prior ``where``)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"))


def distinct_values(df: DataFrame, *cols) -> DataFrame:
    """Distinct values of columns."""
    return df.select(*cols).distinct()


def chunk_count(total, chunk_rows: int):
    """Number of chunks as the studied loader computes it: total // chunk + 1 (A8).  Works on
    a Python int or a Column."""
    if isinstance(total, int):
        return total // chunk_rows + 1
    return (F.floor(total / F.lit(chunk_rows)) + 1).cast("long")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows for eyeballing (O2); the limit is the feature here."""
    return df.limit(n)


def page(df: DataFrame, order_by, offset: int, size: int) -> DataFrame:
    """One page: ``ORDER BY .. LIMIT size OFFSET offset`` with an explicit order (O3, Q13)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).offset(offset).limit(size)


def lookup(df: DataFrame, country=None, state=None, city=None, *, country_col="country",
           state_col="state", city_col="city") -> DataFrame:
    """Hierarchy lookup (F9): equality filters on the partition columns, pruned to the
    matching directories when the table is partitioned by them."""
    for value, col in ((country, country_col), (state, state_col), (city, city_col)):
        if value is not None:
            df = df.where(F.col(col) == F.lit(value))
    return df


def estimated_bytes(df: DataFrame):
    """Content bytes of all rows as a Column aggregate (strings by UTF-8 length)."""
    from geoprep.operators.keyed import row_bytes
    return F.sum(row_bytes(df))


def profile_metrics(df: DataFrame) -> list:
    """Row count and content bytes as observation metrics."""
    from geoprep.operators.keyed import row_bytes
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")]


def profile(df: DataFrame, name: str = "profile"):
    """(observed frame, Observation): attach row count and content bytes to the next action
    on the frame, e.g. its write, so profiling costs no second pass (A7).  After the
    action, ``observation.get`` holds {'rows', 'bytes'}; ``timed`` adds seconds."""
    obs = Observation(name)
    from geoprep.operators.keyed import row_bytes
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"))
    return observed, obs


def timed(action, *args, **kw):
    """(result, seconds) of one call."""
    t = time.perf_counter()
    out = action(*args, **kw)
    return out, time.perf_counter() - t


def load_report(level: str, rows: int, nbytes: int, seconds: float) -> dict:
    """The per-level line: rows, MB, seconds."""
    return {"level": level, "rows": int(rows), "mb": round(nbytes / (1024 * 1024), 4), "seconds": round(seconds, 3)}
