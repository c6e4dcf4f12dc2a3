"""Groups of rows cut into blocks of bounded size, and dealt to the pairs of blocks that may
hold pairs wanted."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def in_blocks(rows: DataFrame, key: str, weight, most: int) -> DataFrame:
    """``rows`` with a block of about ``most`` of the summed ``weight``, within the key.  Neighbouring
    sizes lie together, and the key's largest class lies apart, so that most pairs of blocks of a
    large key cannot fit or are within that class."""
    per = rows.groupBy(key, "label").agg(F.sum(weight).alias("w")).groupBy(key).agg(
        F.sum("w").alias("all"), F.max(F.struct("w", "label"))["label"].alias("major"))
    blocks = F.ceil(F.col("all") / most)
    cut = F.xxhash64(F.floor(F.log(F.col("n").cast("double")) * 16), F.pmod(F.xxhash64("rid"), blocks), F.col("label") == F.col("major"))
    return rows.join(per, key).withColumn("block", F.when(blocks <= 1, F.lit(0).cast("long")).otherwise(cut)).drop("all", "major")


def block_pairs(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """``rows`` (key, block, rid, n, label) dealt to the pairs of blocks (p, q) of a key that may
    hold pairs of different classes and fitting sizes; side 0 meets side 1, 2 meets itself."""
    node = rows.groupBy(key, "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("label").alias("l0"), F.max("label").alias("l1"))
    other = node.select(key, *[F.col(c).alias(f"o_{c}") for c in ("block", "lo", "hi", "l0", "l1")])
    meet = node.join(other, key).where("block <= o_block AND NOT (l0 = l1 AND o_l0 = o_l1 AND l0 = o_l0)") \
        .where((F.col("hi") * 100 >= F.col("o_lo") * percent) & (F.col("o_hi") * 100 >= F.col("lo") * percent)).select(key, "block", "o_block")
    end = lambda at, side: F.struct(F.col(at).alias("at"), F.lit(side).alias("side"))
    ends = F.explode(F.when(F.col("block") == F.col("o_block"), F.array(end("block", 2))).otherwise(F.array(end("block", 0), end("o_block", 1))))
    places = staged(meet, "blocks-meet").select(key, F.col("block").alias("p"), F.col("o_block").alias("q"), ends.alias("e"))
    return rows.join(places.select(key, "p", "q", F.col("e.at").alias("block"), F.col("e.side").alias("side")), [key, "block"])


def grouped(dealt: DataFrame, keys: list, fn, schema: str) -> DataFrame:
    """``fn`` (frame -> frames) over the rows of each key, whose blocks are bounded."""
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        held, key = [], None
        for pdf in batches:
            for k, part in pdf.groupby(keys, sort=False):
                if k != key and held:
                    yield from fn(pd.concat(held))
                    held = []
                key = k
                held.append(part)
        if held:
            yield from fn(pd.concat(held))

    return dealt.repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
