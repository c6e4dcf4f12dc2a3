"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

ROWS = 100_000                  # edges written by a task


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable, for every node of ``links`` (a, b: longs).

    Large star: each node hands its larger neighbours to its smallest one.  Small star: it
    hands its smaller neighbours and itself there.  Both keep connectivity; at the end every
    node points at its component's minimum.  A hub is only ever the many side of a join with
    one row, and minima are pre-aggregated, so no neighbourhood is gathered.
    """
    parts = _parts(links, links.count())
    edges = staged(_larger_first(links).coalesce(parts), "cc-edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))          # no more rows than edges, each with a > b
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(
            F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = staged(_larger_first(small).coalesce(parts), "cc-edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == mark:
            break
        mark, parts = now, _parts(links, now[0])
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _parts(links: DataFrame, rows: int) -> int:
    """Files for about ``rows`` edges: a round's cost should follow its rows, not the number of
    shuffle partitions; all cores write, and no task writes over about twice ``ROWS`` rows."""
    return max(links.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS))


def _larger_first(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
