"""Exact row numbers and batch plans per key (K8, K9), for keys of any size.

Numbers are prefix counts on two levels: rows are range-partitioned on (keys, order), and a
histogram (key, partition) -> rows gives what the earlier partitions of a key hold.

Byte batches are greedy, hence sequential, but a run of rows is a small function of the
bytes already open when it starts.  Those functions are computed per segment in parallel,
composed level by level, and the state each segment starts with is handed down again; the
cut is the one a single pass over the whole key would make, whatever the segment length.
Full rows never leave the JVM: only arrays of sizes pass through Arrow.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoprep.operators.stage import stage_table

LONGS = "array<bigint>"


def _cols(cols) -> list:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on ``keys`` where a null key meets a null key (null keys are one group)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def sequence_within(df: DataFrame, keys, order_by, *, partitions: int | None = None) -> DataFrame:
    """Adds ``seq`` = 1, 2, ... per key in ``order_by`` order, exact, without putting a
    whole key into one task.

    1. Rows are range-partitioned on (keys, order), so a large key is cut across several
       partitions, sorted there, and written with their partition and place.
    2. The histogram (key, partition) -> rows, first place is summed along a key's
       partitions: a window of at most one row per partition for any key.
    3. A row's number is its place in its run plus what the earlier partitions hold.
    ``keys`` + ``order_by`` should identify a row (ties are numbered in stored order).
    """
    keys, order = list(keys), _cols(order_by)
    by = [F.col(k) for k in keys] + order
    cut = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)   # AQE may merge adjacent ranges
    cut = stage_table(cut.sortWithinPartitions(*by).withColumns(
        {"__pid": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "numbered")
    runs = cut.groupBy(*keys, "__pid").agg(F.min("__at").alias("__lo"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)) + 1 - F.col("__lo")).drop("__lo", "__n")
    out = join_null_safe(cut, runs, [*keys, "__pid"])
    return out.withColumn("seq", F.col("__at") + F.col("__before")).select(*df.columns, "seq")


def row_bytes(df: DataFrame, columns=None) -> Column:
    """Content bytes of a row: UTF-8 length of strings, length of binaries, the fixed
    width of other types; nulls count 0 (Q8: content, not interpreter object size)."""
    widths = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
              "date": 4, "timestamp": 8, "timestamp_ntz": 8}
    terms = []
    for name, dtype in df.dtypes:
        if columns is not None and name not in columns:
            continue
        c = F.col(name)
        if dtype == "string":
            t = F.octet_length(c)
        elif dtype == "binary":
            t = F.length(c)
        elif dtype in widths:
            t = F.when(c.isNotNull(), F.lit(widths[dtype]))
        elif dtype.startswith("decimal"):
            t = F.when(c.isNotNull(), F.lit(16))
        else:
            t = F.octet_length(F.to_json(F.struct(c)))
        terms.append(F.coalesce(t.cast("long"), F.lit(0).cast("long")))
    return reduce(lambda a, b: a + b, terms, F.lit(0).cast("long"))


def batch_plan_rows(df: DataFrame, keys, order_by, rows: int, **kw) -> DataFrame:
    """Fixed-count batches per key (K8): ``batch_no`` = (seq - 1) div ``rows``, plus
    ``row_bytes``.  Batches are cut per key in an explicit order (Q25)."""
    if rows <= 0:
        raise ValueError("rows must be positive")
    s = sequence_within(df, keys, order_by, **kw)
    return s.withColumns({"batch_no": F.expr(f"(seq - 1) div {int(rows)}"), "row_bytes": row_bytes(s)})


# ---------------------------------------------------------------------------------------
# K9: what a run of rows does to the open batch
#
# A run maps the bytes open at its start to (batches closed, bytes open at its end).  With
# o bytes open, the first row k with o + size_0 + ... + size_k > limit closes the open
# batch; from there on nothing depends on o.  So the map is a list of pieces (above, closed,
# open), in row order: the first piece with o > above holds, and without one no batch closes
# and o grows by the run's total.  A key starts with nothing open: its first row is taken
# whatever its size (state -1, answer ``fresh``).  Pieces are at most the rows that fit one
# batch, and equal neighbours are merged.
#
# Packed as [total, fresh closed, fresh open, pieces, above..., closed..., open...].


def _pack(total, fresh, above, closed, open_) -> np.ndarray:
    if len(above):
        last = np.r_[(closed[1:] != closed[:-1]) | (open_[1:] != open_[:-1]), True]      # the last of equal pieces reaches furthest
        above, closed, open_ = above[last], closed[last], open_[last]
    return np.r_[total, fresh[0], fresh[1], len(above), above, closed, open_].astype(np.int64)


def _unpack(m: np.ndarray):
    m = np.asarray(m, np.int64)
    n = int(m[3])
    return int(m[0]), (int(m[1]), int(m[2])), m[4:4 + n], m[4 + n:4 + 2 * n], m[4 + 2 * n:]


def run_map(sizes, limit: int) -> np.ndarray:
    """The packed map of one run of row sizes."""
    s = np.asarray(sizes, np.int64)
    upto = np.cumsum(s)
    start = upto - s
    nxt = np.searchsorted(upto, start + limit, side="right")          # first row that no longer fits a batch begun at row j
    nxt = np.maximum(nxt, np.arange(1, len(s) + 1))                   # a row larger than the limit goes alone
    closed, open_ = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
    for j in range(len(s) - 1, -1, -1):
        k = nxt[j]
        closed[j], open_[j] = (0, upto[-1] - start[j]) if k >= len(s) else (closed[k] + 1, open_[k])
    use = np.r_[True, upto[:-1] <= limit]                             # rows that can be the first to close a batch
    return _pack(upto[-1], (closed[0], open_[0]), (limit - upto)[use], closed[use] + 1, open_[use])


def run_apply(m: np.ndarray, state: int) -> tuple[int, int]:
    """(batches closed, bytes open) after the run, from ``state`` bytes open (-1: none yet)."""
    total, fresh, above, closed, open_ = _unpack(m)
    if state < 0:
        return fresh
    k = int(np.searchsorted(-above, -state, side="right"))            # ``above`` falls: the first above < state
    return (int(closed[k]), int(open_[k])) if k < len(above) else (0, state + total)


def run_compose(f: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The map of f's rows followed by g's."""
    tf, ff, af, cf, of = _unpack(f)
    tg, _, ag, cg, og = _unpack(g)
    then = [run_apply(g, int(o)) for o in of]
    c1, o1 = cf + np.array([c for c, _ in then], np.int64), np.array([o for _, o in then], np.int64)
    fc, fo = run_apply(g, ff[1])
    rest = ag - tf                                                    # f closes nothing: g starts with o + tf
    ok = rest < (af[-1] if len(af) else np.iinfo(np.int64).max)
    above = np.r_[af, rest[ok]]
    return _pack(tf + tg, (ff[0] + fc, fo), above, np.r_[c1, cg[ok]], np.r_[o1, og[ok]])


def _batch_of_rows(sizes, limit: int, state: int, closed: int) -> np.ndarray:
    """The batch number of every row of a run."""
    s = np.asarray(sizes, np.int64)
    upto = np.cumsum(s)
    cut = np.zeros(len(s), np.int64)
    k = 0 if state < 0 else int(np.searchsorted(upto, limit - state, side="right"))
    if state >= 0 and k < len(s):
        cut[k] = 1
    while k < len(s):
        k = max(k + 1, int(np.searchsorted(upto, upto[k] - s[k] + limit, side="right")))
        if k < len(s):
            cut[k] = 1
    return closed + np.cumsum(cut)


def states_along(runs: DataFrame, keys: list, start, compose, apply, fan: int = 32) -> DataFrame:
    """keys, __seg, __state: the state in which each run of a key begins, when the first one
    begins in ``start`` and a run's ``__map`` turns one state into the next.

    ``runs``: keys, __seg (0, 1, ... per key), __map (longs).  ``compose(f, g)`` is the map of
    f and then g, ``apply(f, state)`` the state after f, both on lists of longs.  Maps are
    composed ``fan`` at a time, level by level, and states handed down the same levels: a
    task holds ``fan`` maps whatever the key's length, and a level has 1/``fan`` of the rows.
    """
    @F.pandas_udf(LONGS)
    def composed(ms: pd.Series) -> pd.Series:
        return pd.Series([reduce(compose, list(x)) for x in ms])

    @F.pandas_udf("array<array<bigint>>")
    def handed(ms: pd.Series, state: pd.Series) -> pd.Series:
        out = []
        for x, now in zip(ms, state):
            rows = []
            for m in x:
                rows.append(now)
                now = apply(m, now)
            out.append(rows)
        return pd.Series(out)

    most = runs.agg(F.max("__seg")).first()[0] or 0
    level, grouped = runs.select(*keys, "__seg", "__map"), []
    while True:
        up = level.withColumn("__up", F.expr(f"__seg div {fan}")).groupBy(*keys, "__up").agg(
            F.sort_array(F.collect_list(F.struct("__seg", "__map"))).alias("__in"))       # at most ``fan`` maps
        grouped.append(up)
        most //= fan
        if most == 0:
            break
        level = stage_table(up.select(*keys, F.col("__up").alias("__seg"), composed("__in.__map").alias("__map")), "composed-runs")
    now = None
    for up in reversed(grouped):
        if now is None:
            begun = up.withColumn("__state", F.array(*[F.lit(x).cast("long") for x in start]))
        else:
            begun = join_null_safe(up, now.withColumnRenamed("__seg", "__up"), [*keys, "__up"])
        got = begun.withColumn("__out", handed("__in.__map", "__state")).select(
            *keys, F.explode(F.arrays_zip(F.col("__in.__seg").alias("g"), F.col("__out").alias("o"))).alias("z"))
        now = got.select(*keys, F.col("z.g").alias("__seg"), F.col("z.o").alias("__state"))
    return now


def batch_plan_bytes(df: DataFrame, keys, order_by, max_bytes: int, *, segment_rows: int = 4096, fan: int = 32,
                     **kw) -> DataFrame:
    """Byte-bounded batches per key (K9): rows in order; a batch closes when the next row
    would pass ``max_bytes``; a row larger than the limit goes alone (Q8).  The result is
    that of one pass over the whole key for every ``segment_rows`` and ``fan``, which only
    bound what a task holds: the sizes of a segment, the maps of ``fan`` segments."""
    if max_bytes <= 0 or segment_rows <= 0 or fan < 2:
        raise ValueError("max_bytes and segment_rows must be positive, fan at least 2")
    keys = list(keys)
    s = sequence_within(df.withColumn("row_bytes", row_bytes(df)), keys, order_by, **kw)
    s = s.withColumn("__seg", F.expr(f"(seq - 1) div {int(segment_rows)}"))
    sizes = s.groupBy(*keys, "__seg").agg(F.sort_array(F.collect_list(F.struct("seq", "row_bytes")))["row_bytes"].alias("__sizes"))

    @F.pandas_udf(LONGS)
    def maps(s: pd.Series) -> pd.Series:
        return pd.Series([run_map(x, max_bytes) for x in s])

    @F.pandas_udf(LONGS)
    def numbers(sizes: pd.Series, state: pd.Series) -> pd.Series:
        return pd.Series([_batch_of_rows(x, max_bytes, int(o), int(c)) for x, (o, c) in zip(sizes, state)])

    def after(m, state):
        closed, now = run_apply(m, int(state[0]))
        return [now, int(state[1]) + closed]

    sizes = stage_table(sizes.withColumn("__map", maps("__sizes")), "batch-runs")
    states = states_along(sizes, keys, (-1, 0), run_compose, after, fan)
    runs = join_null_safe(sizes.drop("__map"), states, [*keys, "__seg"]).select(*keys, "__seg", numbers("__sizes", "__state").alias("__b"))
    at = F.expr(f"cast((seq - 1) % {int(segment_rows)} as int)")
    return join_null_safe(s, runs, [*keys, "__seg"]).withColumn("batch_no", F.get("__b", at)).select(
        *df.columns, "seq", "row_bytes", "batch_no")


def batch_summary(plan: DataFrame, keys) -> DataFrame:
    """Rows and bytes per batch of a plan (the per-batch size log)."""
    return plan.groupBy(*keys, "batch_no").agg(F.count(F.lit(1)).alias("rows"), F.sum("row_bytes").alias("bytes"))
