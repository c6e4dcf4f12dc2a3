"""What the two classifiers share: the held-out rule and the bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_rest(doc_id, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def held_out(modulus: int, rest: int) -> Column:
    return F.coalesce(crc_rest("doc_id", modulus) == rest, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, rest: int, bound: int) -> DataFrame:
    """doc_id, text, y of at most ``bound`` labelled documents that are not held out, chosen by a
    hash of their id.  A repeated label counts once, the larger value winning; of rows that share
    an id, the one whose text hashes lowest is taken, so the bound is one of rows.  Null ids, null
    labels and ids without a document give no row; an empty table gives none."""
    chosen = (labels.where(F.col(label).isNotNull() & (crc_rest("doc_id", modulus) != rest))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")   # ``bound`` rows
    one = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row"))
    return one.select("doc_id", "row.text", "y")
