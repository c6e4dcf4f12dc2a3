"""Operator 12: near-duplicate classes by MinHash and a multi-index Hamming join.

1. Signatures.  A text's distinct word shingles (hashed to 64 bits) give ``SYMBOLS`` minima of
   independent hashes, each kept as a symbol of b = 16 bits.  Texts with equal sets are one.
2. Multi-index.  The symbols are cut into ``CHUNKS`` chunks.  Two signatures that differ in at
   most ``REACH`` = 2 * CHUNKS - 1 symbols differ in at most one symbol of some chunk
   (pigeonhole), so each chunk is posted once for each symbol that may be wrong, with that one
   left out: every pair within the reach meets in a bucket.  Buckets with the same members are one.
3. Stars.  Each member goes to one centre only, the nearest by signature among the members
   that stand in most buckets; the links found, on full sets, are contracted to classes.
4. Rest.  In buckets that still hold several classes, blocks of bounded size are compared by
   signature inside a task.  The pairs of different classes within the reach make groups (a
   task hands on a spanning forest of its pairs); each group's sets are dealt once more in
   blocks, where links are confirmed on full sets until classes join.  Only sets that share
   one of their rarest shingles there are compared: most pairs within the reach are no links,
   and in a large group of loose copies nearly all of them.
   No list of pairs is formed: what leaves a task is linear in the rows it holds.

The join is exact for the signature distance.  A pair at similarity 0.85 is beyond the reach
with probability 6.3e-7 (binomial, 64 symbols), less above; every link is confirmed exactly.

A null, empty or blank text has an empty set and is linked with nothing.  A text with fewer
words than a shingle is one shingle.  Repeated rows share a class, named by the smallest
doc_id (null only if there is no other).  Other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_pairs, grouped, in_blocks
from .common import scratch, slices, staged
from .components import components
from .jaccard import CHARS, _filter_bits, _may_hold, _mix, _set_hash, links_within, shingle_sets, verified, with_classes

SYMBOLS = 64
CHUNKS = 13
REACH = 2 * CHUNKS - 1
BLOCK = 4096                    # members of a bucket compared at once
TOKENS = 1 << 19                # shingles of a group compared at once (4 MB)
_U = np.uint64
_TURN = np.random.default_rng(12).integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * _U(2) + _U(1)
_CUTS = [c.tolist() for c in np.array_split(np.arange(SYMBOLS), CHUNKS)]


def signatures(sets: list) -> np.ndarray:
    """One row of ``SYMBOLS`` symbols per set; none may be empty."""
    every = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for k, turn in enumerate(_TURN):
        out[:, k] = _mix(np.minimum.reduceat((every ^ (every >> _U(29))) * turn, at)).astype(np.uint16)
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """The ``SYMBOLS`` keys of each signature: a chunk with one of its symbols left out."""
    out = np.empty(sig.shape, np.uint64)
    wide = sig.astype(np.uint64)
    for chunk in _CUTS:
        for left_out in chunk:
            key = np.full(len(sig), left_out + 1, np.uint64)
            for k in chunk:
                if k != left_out:
                    key = _mix(key * _U(0x9E3779B97F4A7C15) + wide[:, k])
            out[:, left_out] = key
    return out.view(np.int64)


def signed_rows(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, h1, h2, n and sig of every row; n is 0 for an empty set."""
    def sign(batches):
        for pdf in slices(batches, chars=CHARS):
            sets = shingle_sets(pdf["text"], words)
            full = [s for s in sets if len(s)]
            sig = iter(signatures(full) if full else [])
            rows = [(doc, *_set_hash(s), len(s), next(sig).tobytes()) if len(s) else (doc, 0, 0, 0, b"") for doc, s in zip(pdf["doc_id"], sets)]
            yield pd.DataFrame(rows, columns=["doc_id", "h1", "h2", "n", "sig"])

    kind = dict(docs.dtypes)["doc_id"]
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(sign, "doc_id string, h1 long, h2 long, n long, sig binary")
    return staged(found.withColumn("doc_id", F.col("doc_id").cast(kind)), "minhash-rows", keep=True)


def buckets(reps: DataFrame) -> DataFrame:
    """t, rid, c: the members of every bucket of two or more, one bucket for equal memberships."""
    def keys(batches):
        for pdf in batches:
            if len(pdf):
                t = chunk_keys(np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(-1, SYMBOLS))
                yield pd.DataFrame({"t": t.ravel(), "rid": np.repeat(pdf["rid"].to_numpy(), SYMBOLS)})

    posted = reps.select("rid", "sig").mapInPandas(keys, "t long, rid long")
    stats = posted.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rid")).alias("x"),
                                    F.bit_xor(F.xxhash64("rid", F.lit(7))).alias("y")).where("c > 1")
    kept = staged(stats.groupBy("c", "x", "y").agg(F.min("t").alias("t")).select("t", "c"), "minhash-buckets")
    wanted = reps.sparkSession.sparkContext.broadcast(_filter_bits(kept, "t"))

    def meeting(batches):                            # most keys stand alone and need not be shuffled again
        bits = np.frombuffer(wanted.value, np.uint8)
        for pdf in keys(batches):
            yield pdf[_may_hold(bits, pdf["t"].to_numpy())]

    return staged(reps.select("rid", "sig").mapInPandas(meeting, "t long, rid long").join(kept, "t"), "minhash-members")


def _differ(x: pd.Series, y: pd.Series) -> np.ndarray:
    a, b = (np.frombuffer(b"".join(v), np.uint16).reshape(-1, SYMBOLS) for v in (x, y))
    return (a != b).sum(1)


def stars(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """a, b: each member b of a bucket with the nearest of its buckets' most central members."""
    @F.pandas_udf("int")
    def differ(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(_differ(x, y))

    degree = members.groupBy("rid").agg(F.count(F.lit(1)).alias("d"))
    centre = members.join(degree, "rid").groupBy("t").agg(F.max(F.struct("d", (-F.col("rid")).alias("r"))).alias("m")).select("t", (-F.col("m.r")).alias("a"))
    pairs = members.join(centre, "t").where("rid <> a").select("a", F.col("rid").alias("b")).distinct()
    near, far = (reps.select(F.col("rid").alias(k), F.col("n").alias(f"n{k}"), F.col("sig").alias(f"s{k}")) for k in "ab")
    sized = pairs.join(near, "a").join(far, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    close = sized.select("a", "b", differ("sa", "sb").alias("d")).where(F.col("d") <= REACH)
    best = close.groupBy("b").agg(F.min(F.struct("d", "a"))["a"].alias("a")).select("a", "b")
    # two that chose each other are one pair
    return staged(best.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", "b").groupBy("x", "y").agg(
        F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b"), "minhash-stars")


def _near(sig: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray, percent: int):
    """For each row of the left side: it, and the rows of the right side within the reach that are
    of another class and a fitting size."""
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    for i in left:
        j = right[label[right] != label[i]]
        j = j[100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])]
        d = (sig[i] != sig[j]).sum(1)
        yield i, j[d <= REACH]


def reach_groups(members: DataFrame, reps: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """rid, n, label, g: the sets that pairs of different classes within the reach still join,
    with their group.  A task hands on a spanning forest of the pairs it finds, not the pairs."""
    rows = members.join(reps.select("rid", "n").join(known, "rid", "left").select("rid", "n", F.coalesce("label", "rid").alias("label")), "rid")
    rows = staged(rows, "minhash-labelled")
    mixed = rows.groupBy("t").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1").select("t")
    rows = staged(rows.join(mixed, "t", "left_semi"), "minhash-mixed")
    rows = staged(in_blocks(rows, "t", F.lit(1), BLOCK), "minhash-blocks")
    dealt = block_pairs(rows, "t", percent).join(reps.select("rid", "sig"), "rid")

    def forest(pdf):
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(-1, SYMBOLS)
        rid, n, label, side = (pdf[c].to_numpy() for c in ("rid", "n", "label", "side"))
        tree, a, b = np.arange(len(rid)), [], []
        for i, j in _near(sig, n, label, side, percent):
            t, at = np.unique(tree[j], return_index=True)
            new = t != tree[i]
            a += [rid[i]] * int(new.sum())
            b += rid[j[at[new]]].tolist()
            if new.any():
                tree[np.isin(tree, t)] = tree[i]
        if a:
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    edges = staged(grouped(dealt.select("t", "p", "q", "side", "rid", "n", "label", "sig"), ["t", "p", "q"], forest, "a long, b long"), "minhash-forest")
    group = components(edges).select(F.col("node").alias("rid"), F.col("label").alias("g"))
    labelled = reps.select("rid", "n").join(known, "rid", "left").select("rid", "n", F.coalesce("label", "rid").alias("label"))
    return staged(group.join(labelled, "rid"), "minhash-groups")


def near_duplicate_classes(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    with scratch():
        texts = docs.select("doc_id", "text")
        rows = signed_rows(texts, words)
        sets = rows.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("doc"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies"))
        reps = staged(sets.withColumn("rid", F.monotonically_increasing_id()), "minhash-reps")
        members = buckets(reps)
        links = verified(stars(members, reps, percent), texts, reps, words, percent)
        known = components(links).withColumnRenamed("node", "rid")
        groups = reach_groups(members, reps, known, percent)
        if groups.limit(1).count():
            links = links.unionByName(links_within(groups, texts, reps, words, percent, TOKENS))
        final = components(links).withColumnRenamed("node", "rid")
        classes = reps.select("rid", "h1", "h2", "n", "doc", "copies").join(final, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
        classes = staged(classes, "minhash-classes")
        named = classes.groupBy("label").agg(F.min("doc").alias("component"))
        classes = classes.join(named, "label").select("h1", "h2", "n", "copies", "label", "component")
        found = with_classes(rows.select("doc_id", "h1", "h2", "n"), classes)
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.col("n") == 0, F.lit(False)).alias("kept"))
