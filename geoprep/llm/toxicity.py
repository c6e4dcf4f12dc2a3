"""Operator 4: toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text.  A
window (``window`` words) is compressed with each; where the toxic dictionary saves bytes,
the window looks toxic.  A document is described by how many of its windows reach each of a
ladder of differences, as counts and as shares, and a logistic unit fitted on the labels
turns that into a probability, so a score of 0.3 is a calibrated threshold.

Which text of a toxic document is the toxic part is not labelled.  The toxic dictionary is
therefore trained on the words of toxic documents that hold character n-grams found far more
often in toxic than in ordinary documents; the ordinary one on words of ordinary documents.

Only the fit is bounded: at most ``bound`` labelled rows that are not held out (whole
texts), ``MOST_GRAMS`` n-grams and ``MOST_WORDS`` training words a dictionary.  Scoring
compresses every window of every text.  Labels, language, source and id are no inputs of a
score.

A null or empty text has no windows and gets the score of that; if the sample holds fewer
than two classes, every score is the share of label 1 (0 if there is no label).  Repeated
rows score alike; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, staged
from .labelled import held_out, training_rows

SAMPLE, LEVEL, DICTIONARY = 6000, 9, 8192
GRAMS, LIFT, SUPPORT, MOST_GRAMS, MOST_WORDS = (4, 5, 6, 7), 1.8, 6, 20_000, 40_000
LADDER = range(-1, 9)
_WORD = re.compile(r"\w+")
_WORKER: dict = {}


def windows(text: str | None, window: int = 1) -> list[str]:
    ws = _WORD.findall(text.lower()) if text else []
    return ws if window == 1 else [" ".join(ws[i:i + window]) for i in range(0, len(ws), window)]


class Compressors:
    """The two dictionaries; ``saved`` is the difference of compressed lengths in bytes."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.raw = (ordinary, toxic)
        self._made = None

    def __getstate__(self):
        return {"raw": self.raw, "_made": None}

    def _lengths(self, which: int, data: list[bytes]) -> np.ndarray:
        import zstandard

        if self._made is None:
            self._made = []
            for raw in self.raw:
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self._made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                           write_checksum=False, write_dict_id=False))
        packed = self._made[which].multi_compress_to_buffer(data, threads=1)
        return np.fromiter((len(packed[i]) for i in range(len(data))), np.int64, len(data))

    def saved(self, found: list[str]) -> np.ndarray:
        if not found:
            return np.zeros(0, np.int64)
        data = [f" {w} ".encode("utf-8", "replace") for w in found]
        return self._lengths(0, data) - self._lengths(1, data)


def describe(saved: np.ndarray) -> np.ndarray:
    """Features of one document from its windows' savings."""
    n = max(1, len(saved))
    counts = np.array([(saved >= t).sum() for t in LADDER], dtype=float)
    return np.concatenate([np.log1p(counts), np.sqrt(counts / n), [np.log(n)]])


def _describe_texts(texts, pair: Compressors, cache: dict, cache_size: int) -> list[np.ndarray]:
    found = [windows(t) for t in texts]
    if len(cache) > cache_size:
        cache.clear()
    new = [w for w in set(chain.from_iterable(found)) if w not in cache]
    known = cache if len(new) <= cache_size else dict(cache)
    known.update(zip(new, pair.saved(new).tolist()))
    return [describe(np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))) for ws in found]


def _train(words: list[bytes]) -> bytes:
    """A dictionary of those samples; what is too little to train on is the dictionary itself."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, words).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(words))[-DICTIONARY:] or b" "


def train_dictionaries(sample: DataFrame) -> Compressors:
    """The dictionaries from labelled rows (text, y)."""
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))).alias("word")
    seen = sample.where(F.col("text").isNotNull()).select(word, "y").groupBy("word").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    seen = staged(seen, "toxic-words")
    n = sample.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in (("a", F.col("y")), ("b", 1 - F.col("y")))]).first()
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    cuts = F.array_distinct(F.flatten(F.array(*[
        F.when(F.length(padded) >= k, F.transform(F.sequence(F.lit(1), F.length(padded) - (k - 1)), lambda i: F.substring(padded, i, F.lit(k))))
        .otherwise(F.array().cast("array<string>")) for k in GRAMS])))
    grams = seen.select(F.explode(cuts).alias("gram"), "a", "b").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    lift = F.log((F.col("a") + 0.5) / (n["a"] + 1)) - F.log((F.col("b") + 0.5) / (n["b"] + 1))
    telling = {r["gram"] for r in grams.where((F.col("a") >= SUPPORT) & (lift > LIFT))
               .orderBy(F.desc(lift * F.sqrt("a")), "gram").limit(MOST_GRAMS).collect()}

    def hits(w: str) -> int:
        w = f" {w} "
        return sum(w[i:i + k] in telling for k in GRAMS for i in range(len(w) - k + 1))

    @F.pandas_udf("int")
    def told(w: pd.Series) -> pd.Series:
        return w.map(hits).astype("int32")

    bad = seen.where("a > 0").withColumn("hits", told("word")).where("hits >= 2") \
        .orderBy(F.desc("a"), "word").limit(MOST_WORDS).collect()
    plain = seen.where("b > 0").orderBy(F.xxhash64("word"), "word").limit(MOST_WORDS).collect()
    toxic = [f" {r['word']} ".encode() for r in bad for _ in range(min(r["a"], 50))]
    return Compressors(_train([f" {r['word']} ".encode() for r in plain for _ in range(min(r["b"], 50))]), _train(toxic))


class Logistic:
    def __init__(self, prior: float = 0.0):
        self.prior, self.w = prior, None

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 10.0) -> "Logistic":
        if len(y) == 0 or y.min() == y.max():
            self.prior = float(y.mean()) if len(y) else 0.0
            return self
        self.mean, self.std = x.mean(0), x.std(0) + 1e-9
        z = np.c_[np.ones(len(x)), (x - self.mean) / self.std]
        self.w = np.zeros(z.shape[1])
        keep = np.r_[0.0, np.full(z.shape[1] - 1, ridge)]
        for _ in range(50):                                     # Newton steps
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(keep + 1e-6)
            self.w -= np.linalg.solve(h, z.T @ (p - y) + keep * self.w)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(x)), (x - self.mean) / self.std] @ self.w, -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 4, rest: int = 2, bound: int = SAMPLE) -> tuple[Compressors, Logistic]:
    sample = staged(training_rows(docs, labels, "toxic", modulus, rest, bound), "toxic-sample")
    pair = train_dictionaries(sample)
    if sample.agg(F.count_distinct("y")).first()[0] < 2:
        y = [r["y"] for r in sample.select("y").collect()]
        return pair, Logistic().fit(np.zeros((len(y), 1)), np.array(y, float))

    def features(batches):
        cache: dict = {}
        for pdf in slices(batches):
            x = _describe_texts(pdf["text"], pair, cache, 1 << 17)
            yield pd.DataFrame({"y": pdf["y"], "x": [r.tobytes() for r in x]})

    rows = sample.select("text", "y").mapInPandas(features, "y int, x binary").collect()
    rows.sort(key=lambda r: (r["x"], r["y"]))
    return pair, Logistic().fit(np.array([np.frombuffer(r["x"]) for r in rows]), np.array([r["y"] for r in rows], float))


def toxicity_score(pair: Compressors, unit: Logistic, cache_size: int = 1 << 18):
    """A column function: text -> score."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        cache = _WORKER.setdefault(hash(pair.raw), {})
        parts = [unit.score(np.array(_describe_texts(pdf["text"], pair, cache, cache_size))) for pdf in slices([text.to_frame("text")])]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 4, rest: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    pair, unit = fit_toxicity(docs, labels, modulus, rest)
    out = docs.select("doc_id", held_out(modulus, rest).alias("held_out"), toxicity_score(pair, unit)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
