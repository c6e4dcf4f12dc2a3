"""Operator 6: exact top-k inner-product search by distributed histogram selection.

Vectors are quantised to integers and packed into blocks.  Every query block meets every
candidate block once and scores all of it (one matrix product).  A block reports for each
query its own k best scores with their rows: nothing below a block's k-th score can be
among the k best of all.  The global k-th value of each query is then located on those
scores by refining histograms: 64 bins over the query's interval, counted over all blocks
with a partial aggregate; the bin that holds the k-th value becomes the next interval,
until it is one integer wide.  Rows at or above that value are kept, and ties go to the
smaller vec_id.

Null vectors, and vectors that hold a null or a non-finite component, take no part.
Vectors of different lengths have no inner product and do not meet.  Rows are told apart
by a row number, so a repeated vec_id stays a candidate of its twin.  Scores are exact in
64-bit integers.  An empty table gives an empty result.  Only vec_id and embedding are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BINS = 64


def quantise(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """uid, vec_id, dim, v (int64 little-endian bytes) of the vectors that take part."""
    x = F.col("embedding")
    ok = x.isNotNull() & F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    ints = (vectors.where(ok & F.col("vec_id").isNotNull())
            .select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                    F.size(x).alias("dim"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("e")))

    def pack(batches):
        for pdf in batches:
            pdf["v"] = [np.asarray(e, dtype="<i8").tobytes() for e in pdf["e"]]
            yield pdf[["uid", "vec_id", "dim", "v"]]

    return ints.mapInPandas(pack, "uid long, vec_id long, dim int, v binary")


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    bound = max(1, q.shape[1]) * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    if bound < 2.0 ** 53:                                  # exact in doubles
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    return q @ c.T


def block_scores(vectors: DataFrame, is_query, k: int, query_block: int = 512, cand_block: int = 4096) -> DataFrame:
    """query, query_id, vec_id, score: for each query and candidate block, its k best."""
    n, nq = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    blocks_q, blocks_c = max(1, math.ceil(nq / query_block)), max(1, math.ceil(n / cand_block))
    h = F.xxhash64("uid")

    def meets(blocks):                       # every block of the other side
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))

    sides = [
        vectors.where(is_query).select("*", F.lit(True).alias("q"), F.pmod(h, F.lit(blocks_q)).alias("qb"),
                                       meets(blocks_c).alias("cb")),
        vectors.select("*", F.lit(False).alias("q"),
                       meets(blocks_q).alias("qb"),
                       F.pmod(h, F.lit(blocks_c)).alias("cb"))]
    both = sides[0].unionByName(sides[1].select(sides[0].columns))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["q"]], pdf[~pdf["q"]].sort_values("vec_id", kind="stable")
        out = []
        if len(a) and len(b):
            dim = int(pdf["dim"].iloc[0])
            m = [np.frombuffer(b"".join(x["v"]), dtype="<i8").reshape(len(x), dim) for x in (a, b)]
            s = _product(*m)
            uid, vec = b["uid"].to_numpy(), b["vec_id"].to_numpy()
            for i, (u, qid) in enumerate(zip(a["uid"], a["vec_id"])):
                row = np.where(uid == u, np.iinfo(np.int64).min, s[i])
                top = np.arange(len(row))
                if len(row) > k + 1:                       # rows tied with the (k+1)-th stay for the sort below
                    top = np.flatnonzero(row >= np.partition(row, -(k + 1))[-(k + 1)])
                top = top[uid[top] != u]
                top = top[np.argsort(-row[top], kind="stable")][:k]     # b is in vec_id order
                out.append(pd.DataFrame({"query": u, "query_id": qid, "vec_id": vec[top], "score": row[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return both.groupBy("dim", "qb", "cb").applyInPandas(score, "query long, query_id long, vec_id long, score long")


def kth_values(scores: DataFrame, k: int) -> DataFrame:
    """query, lo: the k-th largest score of each query (its smallest, if it has fewer)."""
    state = scores.groupBy("query").agg(F.min("score").alias("lo"), F.max("score").alias("hi"),
                                        F.count(F.lit(1)).alias("n")).select(
        "query", "lo", "hi", F.least(F.lit(k).cast("long"), "n").alias("need"))
    state = staged(state, "topk-state")
    span = state.agg(F.max(F.col("hi") - F.col("lo") + 1)).first()[0] or 1
    for _ in range(max(0, math.ceil(math.log(span, BINS) - 1e-9))):
        width = F.ceil((F.col("hi") - F.col("lo") + 1) / F.lit(float(BINS))).cast("long")
        inside = (scores.select("query", "score").join(state, "query")
                  .where(F.col("score").between(F.col("lo"), F.col("hi")))
                  .withColumn("width", width)
                  .withColumn("bin", F.floor((F.col("score") - F.col("lo")) / F.col("width"))))
        hist = inside.groupBy("query", "lo", "hi", "need", "width", "bin").agg(F.count(F.lit(1)).alias("n"))
        down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("upto", F.sum("n").over(down))
        found = hist.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        low = F.col("lo") + F.col("bin") * F.col("width")
        state = staged(found.select("query", low.alias("lo"), F.least(low + F.col("width") - 1, "hi").alias("hi"),
                                    (F.col("need") - F.col("upto") + F.col("n")).alias("need")), "topk-state")
    return state.select("query", "lo")


def top_k(embeddings: DataFrame, k: int = 5, query_step: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by ``query_step``."""
    vectors = staged(quantise(embeddings.select("vec_id", "embedding"), scale), "topk-vectors")
    scores = staged(block_scores(vectors, F.col("vec_id") % query_step == 0, k), "topk-scores")
    kept = scores.join(kth_values(scores, k), "query").where(F.col("score") >= F.col("lo"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
