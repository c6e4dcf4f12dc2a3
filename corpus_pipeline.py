"""A training corpus from ``documents``: junk goes, one document of each group of near
copies stays, documents that hold benchmark text go, personal data is masked, and what is
left is encoded.  Each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoprep.llm import pii
from geoprep.llm.common import bounded_batches, staged, table
from geoprep.llm.jaccard import one_of_each_class
from geoprep.llm.phrases import decontaminate
from geoprep.llm.quality import keep_good
from geoprep.llm.queries import tokenizer_path
from geoprep.llm.unigram import encode_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    bounded_batches(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles."""
    return one_of_each_class(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether they decode to the text."""
    bounded_batches(spark)
    done = encode_documents(docs, tokenizer_path(), decode=True)
    same = F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" "))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("sentencepiece", tokens)]

ORACLE_SQL = None       # a learned classifier and a Viterbi search: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
