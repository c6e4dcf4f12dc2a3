"""Operator 3: quality by attention-based multiple-instance learning.

A document is a bag of passages (``words`` words each).  A passage is described by measures
of its style (shares of character classes, repetition, word lengths), encoded by one tanh
layer, and gets a gated attention weight: softmax over the bag of
``w . (tanh(V h) * sigmoid(U h))``.  The weighted sum of the encodings is the document, and a
logistic unit scores it.  All layers are learned together from document labels alone
(full-batch Adam on the driver).

Only the fit is bounded: at most ``bound`` labelled rows that are not held out, each with all its
passages (136 bytes for 64 words reach the driver).  Scoring reads every passage of every text.
Labels, language, source and id are no inputs of a score.

A null or empty text is a bag of one empty passage and gets a score like any other; if the
sample holds fewer than two classes, every score is the share of label 1 (0.5 if there is
no label at all).  Repeated rows score alike; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .labelled import held_out, training_rows

WORDS, SAMPLE = 64, 4000
_KINDS = 10
_CLASS = np.full(256, 9, np.int64)                      # other symbols
for _i, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
                             b".,", b";:?'\"()-", b"!", b"|"]):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 8                                        # bytes of other scripts and accents
FEATURES = _KINDS + 7


def passages(text: str | None, words: int = WORDS) -> list[list[str]]:
    ws = text.split() if text else []
    return [ws[i:i + words] for i in range(0, len(ws), words)] or [[]]


def measure(ws: list[str]) -> np.ndarray:
    """The style of one passage."""
    out = np.zeros(FEATURES)
    if not ws:
        return out
    raw = np.frombuffer(" ".join(ws).encode("utf-8", "replace"), np.uint8)
    out[:_KINDS] = np.bincount(_CLASS[raw], minlength=_KINDS) / len(raw)
    n = len(ws)
    lengths = np.fromiter(map(len, ws), np.int64, n)
    out[_KINDS:] = (len(set(ws)) / n, sum(a == b for a, b in zip(ws, ws[1:])) / n, np.log1p(lengths.mean()),
                    np.log1p(lengths.max()), (lengths <= 2).mean(), min(1.0, n / WORDS),
                    len({w.lower() for w in ws}) / n)
    return out


def bag_of(text: str | None) -> np.ndarray:
    return np.stack([measure(p) for p in passages(text)])


class Attention:
    """Gated-attention bag classifier."""

    def __init__(self, prior: float = 0.5):
        self.prior, self.p = prior, None

    def _forward(self, x, seg, starts):
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, starts)[seg])
        a = a / np.add.reduceat(a, starts)[seg]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return h, t, s, a, z, y

    def fit(self, bags: list[np.ndarray], y: np.ndarray, steps: int = 400, hidden: int = 16, gate: int = 8, rate: float = 0.02,
            decay: float = 1e-4) -> "Attention":
        if len(y) == 0 or y.min() == y.max():
            self.prior = float(y.mean()) if len(y) else 0.5
            return self
        x = np.concatenate(bags)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        x = np.clip((x - self.mean) / self.std, -8, 8)
        sizes = np.array([len(b) for b in bags])
        starts, seg = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(bags)), sizes)
        r = np.random.default_rng(7)
        f = x.shape[1]
        self.p = p = {"W": r.normal(0, f ** -0.5, (f, hidden)), "b": np.zeros(hidden), "V": r.normal(0, hidden ** -0.5, (hidden, gate)),
                      "U": r.normal(0, hidden ** -0.5, (hidden, gate)), "w": r.normal(0, gate ** -0.5, gate),
                      "c": r.normal(0, hidden ** -0.5, hidden), "d": np.zeros(1)}
        m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            h, t, s, a, z, out = self._forward(x, seg, starts)
            g = (out - y) / len(y)
            dz = (g[:, None] * p["c"])[seg]
            da = (dz * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, starts)[seg])
            gated = de[:, None] * p["w"]
            dt, ds = gated * s * (1 - t * t), gated * t * s * (1 - s)
            dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
            grads = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ g,
                     "d": g.sum(keepdims=True)}
            for k, w in p.items():
                gk = grads[k] + decay * w
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                w -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.p is None or not bags:
            return np.full(len(bags), self.prior)
        sizes = np.array([len(b) for b in bags])
        x = np.clip((np.concatenate(bags) - self.mean) / self.std, -8, 8)
        return self._forward(x, np.repeat(np.arange(len(bags)), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]]))[-1]


def fit_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, rest: int = 1, bound: int = SAMPLE) -> Attention:
    """The classifier learned from a bounded sample of the rows that are not held out."""
    def bags(batches):
        for pdf in slices(batches):
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "bag": [bag_of(t).tobytes() for t in pdf["text"]]})

    rows = training_rows(docs, labels, "quality", modulus, rest, bound) \
        .select(F.col("doc_id").cast("string").alias("doc_id"), "text", "y") \
        .mapInPandas(bags, "doc_id string, y int, bag binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["bag"]))
    return Attention().fit([np.frombuffer(r["bag"]).reshape(-1, FEATURES) for r in rows],
                           np.array([r["y"] for r in rows], dtype=float))


def quality_score(model: Attention):
    """A column function: text -> score."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        parts = [model.score([bag_of(t) for t in pdf["text"]]) for pdf in slices([text.to_frame("text")])]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return score


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, rest: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = fit_quality(docs, labels, modulus, rest)
    out = docs.select("doc_id", held_out(modulus, rest).alias("held_out"), quality_score(model)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``."""
    return docs.where(quality_score(fit_quality(docs, labels))("text") >= threshold)
