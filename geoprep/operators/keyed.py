"""Keyed serving-table semantics on partitioned tables.

A serving table with a primary key takes writes as upserts (last write wins), can refuse
rows whose key has a null part, and is written in batches.  Here these are DataFrame
operators: the merged table is computed with an aggregate per key, rejects are split off
into their own table with a reason, and batch plans are computed per key in a fixed
order.  Nothing loops over rows on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoprep.operators.numbering import (_cols, batch_plan_bytes, batch_plan_rows, batch_summary,  # noqa: F401 - one entry point
                                         row_bytes, sequence_within)


# ---------------------------------------------------------------------------------------
# K12 align, Q10 rejects


def align(df: DataFrame, schema) -> DataFrame:
    """Rows shaped to a target schema: every target column in order, cast to its type; a
    column the frame lacks becomes null (K12).  ``schema`` is a StructType, a DDL string
    or a list of column names (types then kept)."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if isinstance(schema, T.StructType):
        fields = [(f.name, f.dataType) for f in schema.fields]
    else:
        types = dict(df.dtypes)
        fields = [(c, types.get(c, "string")) for c in schema]
    have = set(df.columns)
    return df.select(*[(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in fields])


def reject_reason(keys) -> Column:
    """Why a row is refused: the first null key column by name, null if the key is whole."""
    return F.coalesce(F.lit(None).cast("string"), *[F.when(F.col(k).isNull(), F.lit(f"null key column {k}")) for k in keys])


def split_rejects(df: DataFrame, keys) -> tuple:
    """(accepted, rejected): rows with a null key part are refused with a reason naming the
    first null key column; they are kept, not dropped (Q10)."""
    keys = list(keys)
    tagged = df.withColumn("__reason", reject_reason(keys))
    accepted = tagged.where(F.col("__reason").isNull()).drop("__reason")
    rejected = tagged.where(F.col("__reason").isNotNull()).withColumnRenamed("__reason", "reject_reason")
    return accepted, rejected


# ---------------------------------------------------------------------------------------
# K5, K6 upsert; K7 insert if absent


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Per key, the row that sorts last by ``order`` (ascending columns).

    ``max(struct(order..., row))`` per key: an aggregate with a map-side partial step, so
    a key holding a third of all rows is combined before the shuffle rather than sorted
    inside one task (as a ``row_number`` window would).
    """
    payload = F.struct(*[F.col(c) for c in df.columns]).alias("__row")
    ordered = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(_cols(order))], payload)
    out = df.groupBy(*keys).agg(F.max(ordered).alias("__m"))
    return out.select(*[F.col("__m.__row")[c].alias(c) for c in df.columns])


def upsert(target: DataFrame, batches, keys, order_by) -> tuple:
    """Apply one or more batches to a keyed table, last write wins (K5, K6).

    Later batches win over earlier ones and over the target; inside one batch the row
    last by ``order_by`` wins (an order is required: "last" means nothing without one).
    Returns (table, rejected): rows of the batches with a null key part are refused into
    ``rejected`` with a reason.
    """
    if isinstance(batches, DataFrame):
        batches = [batches]
    if not order_by:
        raise ValueError("upsert needs order_by to decide which write is last")
    keys = list(keys)
    parts, rejects = [target.withColumn("__batch", F.lit(0))], []
    for i, b in enumerate(batches, start=1):
        ok, bad = split_rejects(b, keys)
        parts.append(ok.withColumn("__batch", F.lit(i)))
        rejects.append(bad.withColumn("batch_no", F.lit(i)))
    allrows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    merged = last_per_key(allrows, keys, [F.col("__batch"), *_cols(order_by)]).drop("__batch")
    rejected = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejects)
    return merged, rejected


def insert_absent(target: DataFrame, new: DataFrame, keys, order_by=None) -> DataFrame:
    """Rows of ``new`` whose key is not in ``target`` yet, one per key -- the first by
    ``order_by`` (K7, ``INSERT ... IF NOT EXISTS``).  Null-key rows are not inserted."""
    keys = list(keys)
    ok, _ = split_rejects(new, keys)
    if order_by:
        payload = F.struct(*[F.col(c) for c in ok.columns]).alias("__row")
        ordered = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(_cols(order_by))], payload)
        first = ok.groupBy(*keys).agg(F.min(ordered).alias("__m")).select(
            *[F.col("__m.__row")[c].alias(c) for c in ok.columns])
    else:
        first = ok.dropDuplicates(keys)
    return first.join(target.select(*keys).distinct(), keys, "left_anti")


# ---------------------------------------------------------------------------------------
# K11 write report, K15 clustering order


def write_report(table: str, df: DataFrame, keys) -> DataFrame:
    """Outcome counts of writing ``df`` to a table with that key: (table, outcome, reason, rows)
    (K11).  One pass over ``df`` with partial counts before the shuffle; an empty frame has no rows."""
    reason = reject_reason(keys)
    outcome = F.when(reason.isNull(), F.lit("written")).otherwise(F.lit("rejected"))
    return df.groupBy(outcome.alias("outcome"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit(table).alias("table"), "outcome", "reason", "rows")


def cluster_order(df: DataFrame, cluster_key, descending_col: str, partitions: int | None = None) -> DataFrame:
    """Rows laid out by ``cluster_key`` with ``descending_col`` newest first inside it
    (K15, ``CLUSTERING ORDER BY (timestamp DESC)``).  Range partitioning on both columns
    cuts a hot key across partitions instead of loading it into one."""
    keys = [cluster_key] if isinstance(cluster_key, str) else list(cluster_key)
    cols = [F.col(k) for k in keys] + [F.col(descending_col).desc()]
    laid = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return laid.sortWithinPartitions(*keys, F.col(descending_col).desc())
