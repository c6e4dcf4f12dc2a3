"""Operator 11: hard negatives by cover trees over norm-augmented candidates.

Vectors become integers and get one more coordinate that lifts all of them to the same norm
M, so an inner product with a query is a matter of the angle alone.

1. Blocks.  A vector goes to its label and its nearest pivot (farthest-first among a bounded
   sample) and is numbered there, so a label or pivot of any size is cut into blocks of
   ``block`` rows.  A pivot only says which vectors lie together: results do not depend on it.
2. A cover tree per block, built in a task: a node's children are centres farther apart than
   half its covering radius, each with what is nearest to it; the radii kept are those reached.
3. Search.  Anchors go in panels of bounded bytes, broadcast, over the blocks.  For a node at
   angle t from the query and angular radius r, inner products lie between |q| M cos(t + r) and
   |q| M cos(t - r): nodes outside the window of scores, or below the worst row kept, are
   skipped, the others taken best first, and rows of leaves compared exactly.  A task keeps an
   anchor's best over all its blocks, so it hands on k rows for each anchor and window.
4. First the positives (same label, any score), then the windows their scores open, over the
   other labels.

Rows with a null label, vec_id or vector, or a null or non-finite component take no part, and
vectors of different lengths do not meet.  Rows are told apart by a number, so a repeated
vec_id is another row.  Ties go to the smaller vec_id.  An empty table, or anchors without
positives or without negatives in the window, give no rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoprep.operators.numbering import sequence_within
from geoprep.session import scratch_dir

from .common import staged

LEAF = 8                     # rows of a node that is not divided further
SAMPLE = 4096                # rows among which pivots are chosen
PIVOTS = 256                 # at most
PANEL_BYTES = 8 << 20        # anchors sent to the tasks at once
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def lifted(points: np.ndarray, m: float) -> np.ndarray:
    """Integer vectors with the coordinate that gives each the norm ``m``."""
    x = points.astype(float)
    return np.hstack([x, np.sqrt(np.maximum(m * m - (x * x).sum(1), 0.0))[:, None]])


class CoverTree:
    """Cover tree over the rows of ``points`` (integers), lifted to norm ``m``.

    Nodes are numbered breadth first, a node's children in a row: centre (a row), radius,
    children [first, upto), and for a leaf its rows [begin, end) of ``rows``."""

    def __init__(self, points: np.ndarray, m: float):
        self.points, self.m = lifted(points, m), m
        centre, radius, first, upto, begin, end, rows = [], [], [], [], [], [], []
        every = np.arange(len(points))
        queue = [(0, every, self._from(0, every))]
        at = 0
        while at < len(queue):
            c, members, d = queue[at]
            at += 1
            centre.append(c)
            radius.append(float(d.max()))
            first.append(len(queue))
            if len(members) > LEAF and radius[-1] > 0:
                queue += self._children(c, members, d, radius[-1] / 2)
                begin.append(0)
                end.append(0)
            else:
                begin.append(len(rows))
                rows += members.tolist()
                end.append(len(rows))
            upto.append(len(queue))
        self._nodes(np.array([centre, first, upto, begin, end]), np.array(radius), np.array(rows))

    def _nodes(self, shape: np.ndarray, radius: np.ndarray, rows: np.ndarray):
        m = self.m
        self.shape, self.radius, self.rows = shape.astype(np.int64), radius, rows.astype(np.int64)
        self.centre = self.shape[0]
        self.first, self.upto, self.begin, self.end = (x.tolist() for x in self.shape[1:])
        self.turn = 2 * np.arcsin(np.minimum(1.0, self.radius / (2 * m) * (1 + 1e-9))) if m > 0 else np.zeros(len(radius))

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.shape.tobytes(), self.radius.tobytes(), self.rows.tobytes()

    @classmethod
    def unpacked(cls, points: np.ndarray, m: float, shape: bytes, radius: bytes, rows: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        tree.points, tree.m = lifted(points, m), m
        tree._nodes(np.frombuffer(shape, np.int64).reshape(5, -1), np.frombuffer(radius), np.frombuffer(rows, np.int64))
        return tree

    def _from(self, c: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[members] - self.points[c]) ** 2).sum(1))

    def _children(self, c: int, members: np.ndarray, d: np.ndarray, reach: float) -> list:
        """Centres more than ``reach`` apart, the parent's own first, with the members nearest to each."""
        near, owner, centres = d.copy(), np.zeros(len(members), int), [c]
        while near.max() > reach:
            new = int(members[near.argmax()])
            e = self._from(new, members)
            closer = e < near
            near[closer], owner[closer] = e[closer], len(centres)
            centres.append(new)
        by = np.argsort(owner, kind="stable")
        cut = np.searchsorted(owner[by], np.arange(len(centres) + 1))
        return [(centres[k], members[by[a:b]], near[by[a:b]]) for k, (a, b) in enumerate(zip(cut, cut[1:]))]

    def search(self, q: np.ndarray, windows: list, k: int, best: list, uid: np.ndarray, vec: np.ndarray, own: int, exact: np.ndarray) -> int:
        """Add to ``best`` (a heap of (score, -vec_id, uid) for each window (low, high)) what this
        tree has among the window's k best.  Returns the nodes opened."""
        length = math.sqrt(float((q * q).sum()))
        scale = length * self.m
        slack = 1.0 + 1e-9 * scale
        q1 = np.append(q, 0.0)
        seen: dict = {}

        def bounds(nodes, scores):
            t = np.arccos(np.clip(scores / scale, -1.0, 1.0)) if scale > 0 else np.zeros(len(scores))
            r = self.turn[nodes]
            return scale * np.cos(np.minimum(math.pi, t + r)) - slack, scale * np.cos(np.maximum(0.0, t - r)) + slack

        def take(heap, rows, low, high):
            if not len(rows):
                return
            s = exact[rows] @ q_int
            ok = (s >= low) & (s <= high) & (uid[rows] != own)
            if len(heap) == k:
                ok &= s >= heap[0][0]
            s, rows = s[ok], rows[ok]
            if len(s) > 4 * k:
                few = s >= np.partition(s, -k)[-k]
                s, rows = s[few], rows[few]
            for score, v, u in zip(s.tolist(), vec[rows].tolist(), uid[rows].tolist()):
                item = (score, -v, u)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item[:2] > heap[0][:2]:
                    heapq.heapreplace(heap, item)

        q_int = q.astype(np.int64)
        opened = 0
        for (low, high), heap in zip(windows, best):
            if low > high:
                continue
            queue = [(-math.inf, 0)]
            while queue:
                top, node = heapq.heappop(queue)
                if len(heap) == k and -top < heap[0][0]:
                    break
                opened += 1
                if self.end[node] > self.begin[node]:
                    take(heap, self.rows[self.begin[node]:self.end[node]], low, high)
                    continue
                if node not in seen:
                    nodes = np.arange(self.first[node], self.upto[node])
                    seen[node] = nodes, *bounds(nodes, self.points[self.centre[nodes]] @ q1)
                nodes, least, most = seen[node]
                ok = (most >= low) & (least <= high)
                if len(heap) == k:
                    ok &= most >= heap[0][0]
                single = ok & (self.radius[nodes] == 0)          # leaves without extent: their rows are compared at once
                inside = nodes[single]
                if len(inside):
                    take(heap, np.concatenate([self.rows[self.begin[n]:self.end[n]] for n in inside]), low, high)
                rest = ok & ~single
                for n, u in zip(nodes[rest].tolist(), np.minimum(most[rest], float(high)).tolist()):
                    heapq.heappush(queue, (-u, n))
        return opened


def participants(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """uid, vec_id, label, dim, v (int64 little-endian bytes) of the rows that take part."""
    x = F.col("embedding")
    ok = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    ints = embeddings.where(x.isNotNull() & ok & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.size(x).alias("dim"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("e"))

    def pack(batches):
        for pdf in batches:
            e = [np.asarray(e, dtype="<i8") for e in pdf["e"]]
            pdf["v"] = [x.tobytes() for x in e]
            pdf["norm"] = [float(np.sqrt((x.astype(float) ** 2).sum())) for x in e]
            yield pdf[["uid", "vec_id", "label", "dim", "v", "norm"]]

    return staged(ints.mapInPandas(pack, "uid long, vec_id long, label long, dim int, v binary, norm double"), "negatives-vectors")


def _matrix(v, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(v), dtype="<i8").reshape(len(v), dim)


def _pivots(vectors: DataFrame, n: int, m: float, block: int) -> dict:
    """dim -> pivots, farthest first among at most ``SAMPLE`` rows (chosen by a hash); at most ``PIVOTS`` in all."""
    rows = vectors.select("uid", "dim", "v").orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).toPandas()
    out, many = {}, min(PIVOTS, max(1, n // (8 * block)))
    for dim, part in rows.groupby("dim"):
        x = lifted(_matrix(part["v"], int(dim)), m)
        chosen, near = [0], ((x - x[0]) ** 2).sum(1)
        while len(chosen) < max(1, many * len(part) // len(rows)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
        out[int(dim)] = x[chosen]
    return out


def blocks_of(vectors: DataFrame, m: float, n: int, block: int) -> DataFrame:
    """The vectors with label, pivot and chunk: at most ``block`` rows each."""
    pivots = vectors.sparkSession.sparkContext.broadcast(_pivots(vectors, n, m, block))

    def nearest(batches):
        for pdf in batches:
            pdf["pivot"] = 0
            for dim, part in pdf.groupby("dim"):
                p = pivots.value.get(int(dim))
                if p is not None and len(p) > 1:
                    x = lifted(_matrix(part["v"], int(dim)), m)
                    pdf.loc[part.index, "pivot"] = ((p * p).sum(1)[None] - 2 * x @ p.T).argmin(1)
            yield pdf[["uid", "vec_id", "label", "dim", "v", "pivot"]]

    placed = vectors.mapInPandas(nearest, "uid long, vec_id long, label long, dim int, v binary, pivot int")
    return sequence_within(placed, ["dim", "label", "pivot"], ["uid"]).withColumn("chunk", F.expr(f"(seq - 1) div {int(block)}"))


TREE = ["v", "uid", "vec", "shape", "radius", "rows"]


def build_trees(blocks: DataFrame, m: float) -> DataFrame:
    """dim, label and a cover tree with its rows as packed arrays, one row a block."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        exact = _matrix(pdf["v"], dim)
        arrays = (exact.tobytes(), pdf["uid"].to_numpy().tobytes(), pdf["vec_id"].to_numpy().tobytes(), *CoverTree(exact, m).packed())
        return pd.DataFrame({"dim": [dim], "label": [int(pdf["label"].iloc[0])]} | {c: [x] for c, x in zip(TREE, arrays)})

    grouped = blocks.select("dim", "label", "pivot", "chunk", "uid", "vec_id", "v").groupBy("dim", "label", "pivot", "chunk")
    return staged(grouped.applyInPandas(build, "dim int, label long, " + ", ".join(f"{c} binary" for c in TREE)), "negatives-trees")


def _winners(trees: DataFrame, panel: list, k: int, same: bool, m: float) -> DataFrame:
    """anchor, window, score, vec_id, uid: for every task, the k best of each anchor and window.
    ``panel``: (uid, label, dim, v, windows) of the anchors."""
    sent = trees.sparkSession.sparkContext.broadcast(panel)

    def run(batches):
        best = [[[] for _ in a[4]] for a in sent.value]
        for pdf in batches:
            for dim, label, v, uid, vec, *nodes in zip(pdf["dim"], pdf["label"], *(pdf[c] for c in TREE)):
                tree = None
                for a, kept in zip(sent.value, best):
                    if a[2] == dim and (a[1] == label) == same:
                        if tree is None:
                            uid, vec = (np.frombuffer(x, np.int64) for x in (uid, vec))
                            exact = np.frombuffer(v, "<i8").reshape(len(uid), dim)
                            tree = CoverTree.unpacked(exact, m, *nodes)
                        tree.search(np.frombuffer(a[3], "<i8").astype(float), a[4], k, kept, uid, vec, a[0], exact)
        rows = [(a[0], w, s, -v, u) for a, kept in zip(sent.value, best) for w, heap in enumerate(kept) for s, v, u in heap]
        yield pd.DataFrame(rows, columns=["anchor", "window", "score", "vec_id", "uid"]).astype("int64")

    found = trees.mapInPandas(run, "anchor long, window long, score long, vec_id long, uid long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _in_panels(anchors: DataFrame, trees: DataFrame, k: int, same: bool, m: float, name: str) -> DataFrame:
    """``_winners`` over all anchors (uid, label, dim, v, windows), a bounded panel at a time."""
    spark = anchors.sparkSession
    n, widest = anchors.agg(F.count(F.lit(1)), F.max(F.length("v") + 16 * F.size("windows") + 64)).first()
    size = max(1, PANEL_BYTES // (widest or 1))
    numbered = staged(sequence_within(anchors, [], ["uid"]), f"{name}-anchors") if n > size else anchors.withColumn("seq", F.lit(1))
    path = scratch_dir(spark, f"llm-{name}")
    schema = "anchor long, window long, score long, vec_id long, uid long, rank int"
    spark.createDataFrame([], schema).write.parquet(path)
    for start in range(0, n, size):
        rows = numbered.where(F.col("seq").between(start + 1, start + size)).select("uid", "label", "dim", "v", "windows").collect()
        panel = [(r["uid"], r["label"], r["dim"], bytes(r["v"]), [tuple(w) for w in r["windows"]]) for r in rows]
        _winners(trees, panel, k, same, m).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def mine(embeddings: DataFrame, *, anchor_step: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, block: int = 1024) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each
    anchor (vec_id divisible by ``anchor_step``) and each of its ``positives`` best rows of the
    same label, the ``negatives`` best rows of other labels that score between ``low`` and
    ``high`` per cent of the positive."""
    vectors = participants(embeddings.select("vec_id", "embedding", "label"), scale)
    n, m = vectors.agg(F.count(F.lit(1)), F.max("norm")).first()
    m = float(m or 0.0) * (1 + 1e-12)
    trees = build_trees(blocks_of(vectors, m, n, block), m)
    anchors = vectors.where(F.col("vec_id") % anchor_step == 0).select("uid", "vec_id", "label", "dim", "v")
    open_ = F.array(F.array(F.lit(LOWEST), F.lit(HIGHEST)))
    pos = _in_panels(anchors.withColumn("windows", open_), trees, positives, True, m, "negatives-positives")
    pos = pos.select(F.col("anchor").alias("uid"), F.col("rank").alias("p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # 100 s >= low p and 100 s <= high p, for integers s
    least, most = F.expr(f"-floor(-positive_score * {low} / 100d)"), F.expr(f"floor(positive_score * {high} / 100d)")
    if low * high and m * m * max(low, high) >= 2.0 ** 52:                    # beyond exact doubles
        least = F.expr(f"cast(ceil(cast(positive_score as decimal(38,0)) * {low} / 100) as long)")
        most = F.expr(f"cast(floor(cast(positive_score as decimal(38,0)) * {high} / 100) as long)")
    windows = pos.groupBy("uid").agg(F.array_sort(F.collect_set(F.array(least.cast("long"), most.cast("long")))).alias("windows"))
    wanted = staged(anchors.join(windows, "uid"), "negatives-windows")
    neg = _in_panels(wanted, trees, negatives, False, m, "negatives-found").select(
        F.col("anchor").alias("uid"), "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    place = F.array_position("windows", F.array(least.cast("long"), most.cast("long"))) - 1
    asked = pos.join(wanted.select("uid", "windows", F.col("vec_id").alias("anchor_id")), "uid").withColumn("window", place).drop("windows")
    return asked.join(neg, ["uid", "window"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                                                    "positive_score", "negative_score")
