"""Value-list filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INLINE_LIMIT = 256


def filter_values(df: DataFrame, column: str, values, *, inline_limit: int = INLINE_LIMIT) -> DataFrame:
    """Rows whose ``column`` is in ``values``.  A short list stays an ``IN`` predicate
    (pushed into the scan); a long one becomes a left-semi join against a one-column
    table whose size is the list's, so it can be broadcast safely."""
    values = list(dict.fromkeys(values))
    if len(values) <= inline_limit:
        return df.where(F.col(column).isin(*values))
    dtype = dict(df.dtypes)[column]
    keys = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} {dtype}")
    return df.join(F.broadcast(keys), column, "left_semi")
