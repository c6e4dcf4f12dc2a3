"""Operator 8: token counts by a map-side two-tier lookup.

1. Each task counts the pre-tokens of all its documents and reports its most frequent ones
   (a bounded summary; rare ones are dropped while counting, which only costs lookups
   later).  The summed summaries give the ``table_size`` most frequent pre-tokens, whose
   token counts form the broadcast table: at most ``table_size`` strings of at most
   ``max_len`` characters.
2. Each task looks its pre-tokens up in that table, then in the worker's cache; the rest is
   encoded by the library, in one call a batch, and enters the cache (``cache_size``
   entries, then it starts anew).  No pre-token is shuffled.

The result does not depend on the table, its size or the cache.  A null or empty text has
no bytes and no tokens.  Rows are handled alone: repeated rows and any other columns do not
matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .pieces import check_vocabulary, pre_tokens

_WORKER: dict = {}


def _processor(model: str):
    if model not in _WORKER:
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model)
        # the empty pre-token is one space at a text's end; the library would drop it alone
        _WORKER[model] = (lib, len(lib.encode("a ")) - len(lib.encode("a")), {})
    return _WORKER[model]


def frequent_pre_tokens(docs: DataFrame, table_size: int = 32768, per_task: int = 4096, max_len: int = 64,
                        counted: int = 200_000) -> list[str]:
    """The most frequent pre-tokens over all documents, by bounded per-task summaries."""
    def summary(batches):
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(pre_tokens(text))
                if len(seen) > counted:
                    low = 1
                    while len(seen) > counted // 2:        # forget the rarest
                        seen = Counter({w: n for w, n in seen.items() if n > low})
                        low *= 2
        top = [(w, n) for w, n in seen.most_common(per_task) if n > 1 and 0 < len(w) <= max_len]
        yield pd.DataFrame({"word": [w for w, _ in top], "n": [n for _, n in top]}).astype({"word": object, "n": "int64"})

    sums = docs.select("text").where(F.col("text").isNotNull()).mapInPandas(summary, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in sums.orderBy(F.desc("n"), "word").limit(table_size).collect()]


def count_tokens(docs: DataFrame, model: str, *, limit: int = 4096, table_size: int = 32768,
                 cache_size: int = 1 << 18) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document; ``model``: a SentencePiece
    model file that every executor can open."""
    spark = docs.sparkSession
    sp = _processor(model)[0]
    check_vocabulary(sp.id_to_piece(list(range(sp.vocab_size()))))
    words = frequent_pre_tokens(docs, table_size)
    table = spark.sparkContext.broadcast({w: len(x) for w, x in zip(words, sp.encode(words, num_threads=1))} if words else {})

    def count(batches):
        lib, last_space, cache = _processor(model)
        frequent = table.value
        for pdf in slices(batches):
            rows = [pre_tokens(t) if isinstance(t, str) else [] for t in pdf["text"]]
            if len(cache) > cache_size:
                cache.clear()
            cache[""] = last_space
            missing = [w for w in set(chain.from_iterable(rows)) if w not in frequent and w not in cache]
            if missing:
                cache.update(zip(missing, map(len, lib.encode(missing, num_threads=1))))
            # a word of one tier is found there, else in the other
            look = _Tiers(frequent, cache)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"],
                                "n_tokens": [sum(map(look, ws)) for ws in rows]}).astype({"n_tokens": "int64"})

    source = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    out = source.select(F.col("doc_id").cast("string").alias("doc_id"), "n_bytes", "text") \
        .mapInPandas(count, "doc_id string, n_bytes long, n_tokens long")
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))


class _Tiers:
    def __init__(self, frequent: dict, cache: dict):
        self.get, self.other = frequent.get, cache.__getitem__

    def __call__(self, word: str) -> int:
        n = self.get(word)
        return self.other(word) if n is None else n
