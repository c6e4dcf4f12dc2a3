"""Operator 9: sharding by a hierarchical weighted hash tree.

Each row descends region -> rack -> shard.  At a node every child draws ``ln(u) / weight``
with ``u`` a hash of (doc_id, child path), and the largest draw wins, so a child gets its
share of the weight and, when one child's weight rises, rows move only into that child's
subtree.  The default tree holds two shards a rack and two racks a region; the ninth shard
opens a region of its own, so growing 8 shards to 9 moves rows only into the new shard.

``slot`` numbers the rows of a shard without gaps: scan partitions are staged with their
partition number, rows are numbered inside (partition, shard), and the offset of each
(partition, shard) comes from a table of counts.  No shard is gathered in one task.

Nulls: a null text has size 1 and CRC 0; a null doc_id hashes like an absent value.  Equal
rows get slots of their own.  An empty table gives an empty result.  Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged


def default_tree(shards: int, per_rack: int = 2, racks_per_region: int = 2, weights=None) -> list[tuple]:
    """[(region, rack, shard, weight)] for shards 0..n-1."""
    return [(s // (per_rack * racks_per_region), s // per_rack, s, float((weights or {}).get(s, 1.0)))
            for s in range(shards)]


def _winner(key: Column, level: str, children: dict) -> Column:
    """The child (an int) with the largest weighted draw; ``children``: child -> weight."""
    if len(children) == 1:
        return F.lit(next(iter(children)))
    draws = []
    for child, weight in sorted(children.items()):
        h = F.pmod(F.xxhash64(key, F.lit(f"{level}/{child}")), F.lit(1 << 52))
        u = (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
        draws.append(F.struct((F.log(u) / F.lit(weight)).alias("draw"), F.lit(-child).alias("child")))
    return -F.greatest(*draws)["child"]


def descend(key: Column, tree: list[tuple]) -> Column:
    """The shard that ``key`` reaches in ``tree``; children of weight 0 get no rows."""
    regions: dict = defaultdict(lambda: defaultdict(dict))
    for region, rack, shard, weight in tree:
        if weight > 0:
            regions[region][rack][shard] = weight
    if not regions:
        raise ValueError("the tree holds no shard of positive weight")
    by_rack = {rack: _winner(key, "shard", leaves) for racks in regions.values() for rack, leaves in racks.items()}
    by_region = {}
    for region, racks in regions.items():
        pick = _winner(key, "rack", {r: sum(leaves.values()) for r, leaves in racks.items()})
        by_region[region] = _choose(pick, {r: by_rack[r] for r in racks})
    pick = _winner(key, "region", {g: sum(sum(x.values()) for x in racks.values()) for g, racks in regions.items()})
    return _choose(pick, by_region)


def _choose(pick: Column, branches: dict) -> Column:
    items = list(branches.items())
    out = items[-1][1]
    for value, branch in reversed(items[:-1]):
        out = F.when(pick == value, branch).otherwise(out)
    return out


def shard_documents(docs: DataFrame, tree: list[tuple], grown: list[tuple] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard."""
    text = F.col("text")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        descend(F.col("doc_id"), tree).cast("int").alias("shard"),
        (descend(F.col("doc_id"), grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("pid"))
    rows = staged(rows, "shards")
    counts = rows.groupBy("shard", "pid").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("pid", "shard").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("rn", F.row_number().over(within))
            .join(offsets, ["pid", "shard"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rn") - 1).cast("long").alias("slot"),
                    "grown_shard"))
