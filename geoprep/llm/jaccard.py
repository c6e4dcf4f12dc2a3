"""Operator 5: exact Jaccard self-join on word shingles by signature trees.

Sets are hashed shingles (64 bits).  Equal sets are one from the start.

1. Forest.  Shingles are ordered by how full their hash bucket is over the whole corpus
   (4,194,304 counts), then by hash.  Two sets similar enough share one of the first
   ``n - ceil(t n) + 1`` shingles of their order, so each such shingle roots a tree over the
   sets that have it there; trees over the same sets are kept once.
2. Stars.  Every member is compared with one other: of the most central members of its trees
   (those in most trees), the one it shares most trees with.  The links found are contracted
   to classes, and trees whose members are all in one class are done: this settles groups of
   copies without forming their pairs.  A member of a tree whose neighbours by size are too
   small and too large for it leaves the tree: most of those that share a shingle by chance.
3. Dual traversal of the rest.  A node holds the OR of its members' token bitmaps, the range
   of their sizes, the most tokens any member loses to bitmap collisions, and the range of
   its classes.  For two nodes, common bits plus that loss bound any overlap of their
   members; a pair of nodes goes if the bound or the sizes rule out the similarity, or if
   both are within one class.  The top level (blocks of a large tree) is a join of node
   summaries; the levels below run inside a task on at most two blocks.
4. The pairs that survive make groups: a task hands on a spanning forest of its pairs, so no
   list of pairs is formed and what leaves a task is linear in the rows it holds.  The sets of
   a group are dealt once more in blocks, where those of different classes that share a rare
   shingle are compared exactly until classes join, and the links are contracted again.

A class is exact: every linked pair is compared, or already lies in one class.  Nothing is
capped: a tree or group of any size is cut into blocks of bounded size.

A null, empty or blank text is an empty set and linked with nothing.  A text with fewer
words than a shingle is one shingle.  Rows with equal sets, repeated ids among them, share a
class, named by the smallest doc_id.  Other columns are not read; an empty table gives an
empty result.  Only words of bytes 0x21-0x7F (letters A-Z in lower case) and beyond are
told apart by their bytes, as UTF-8.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import block_pairs, grouped, in_blocks
from .common import bounded_batches, scratch, slices, staged
from .components import components

BUCKETS = 1 << 22
PAGE = 1 << 16                  # bucket counts in a row
BLOCK = 2048                    # members of a block of a large tree
FAN = 16                        # children of a node inside a task
TOKENS = 1 << 19                # shingles of a group compared at once (4 MB)
GROUP = 512                     # partners compared with one set in one group
FILTER_BITS = 1 << 27           # bits of a broadcast filter (16 MB whatever the input)
PIECE = 1 << 20                 # bytes hashed at once
CHARS = 1 << 19                 # characters of texts held as arrays at once
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(11)
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_VALUE[_SPACE] = 0
_VALUE = _VALUE[_LOWER]
_BASE = _RANDOM.integers(1 << 62, 1 << 63, dtype=np.uint64) | _U(1)
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of every word of ``raw``."""
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        while end < len(raw) and not _SPACE[raw[end]]:        # cut at white space
            end += 1
        b = np.frombuffer(raw, np.uint8, end - at, at)
        blank = _SPACE[b]
        first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        if len(first):
            word = np.cumsum(np.bincount(first, minlength=len(b))) - 1
            inside = np.arange(len(b)) - first[np.maximum(word, 0)]
            inside[blank] = 0
            places = _mix(np.arange(1, int(inside.max()) + 2, dtype=np.uint64) * _BASE) | _U(1)       # of no common base
            sums = np.add.reduceat(_VALUE[b] * places[inside], first)
            starts.append(first + at)
            hashes.append(_mix(sums))
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts, words: int) -> list[np.ndarray]:
    """The sorted set of hashed shingles of each text."""
    raws = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])
    start, h = word_hashes(b"\n".join(raws))
    cut = np.searchsorted(start, begin)
    rolled = np.zeros(len(h), np.uint64)
    for k in range(words):
        m = max(0, len(h) - k)                 # fewer words than k: nothing to add
        rolled[:m] += h[k:k + m] * _PLACE[k]
    rolled = _mix(rolled)
    out = []
    for a, b in zip(cut, cut[1:]):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            out.append(_mix((h[a:b] * _PLACE[:b - a]).sum(keepdims=True) + _U(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    two = np.array([s.sum(), _mix(s ^ _PLACE[50]).sum()], np.uint64).view(np.int64)
    return int(two[0]), int(two[1])


def needed_overlap(a, b, percent: int):
    """The least intersection of sets of sizes a and b with 100 * inter >= percent * union."""
    return (percent * (a + b) + 99 + percent) // (100 + percent)


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> _U(65 - BUCKETS.bit_length())).astype(np.int64)


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes in the same order: exact below 32, then eight steps to a doubling."""
    steps = 32 + 8 * (np.log2(np.maximum(counts, 32)) - 5)
    return np.where(counts < 32, counts, np.minimum(steps, 255)).astype(np.uint8)


def hashed_rows(docs: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """(rows, load): doc_id, h1, h2, n (0 for an empty set) and the columns of ``docs`` other than
    text for every document, staged; and the level of how many (document, shingle) pairs fall
    into each hash bucket, over all documents.  One pass over the texts gives both: a task
    hands on its counts in compressed pages, and those of a page are added up in a stream."""
    other = [c for c in docs.columns if c not in ("doc_id", "text")]
    schema = "doc_id string, h1 long, h2 long, n long, page int, load binary" + "".join(f", {c} long" for c in other)

    def run(batches):
        total = np.zeros(BUCKETS, np.uint32)
        for pdf in slices(batches, chars=CHARS):
            sets = shingle_sets(pdf["text"], words)
            np.add.at(total, _bucket(np.concatenate(sets)), np.uint32(1))
            out = pd.DataFrame([(*_set_hash(s), len(s)) for s in sets], columns=["h1", "h2", "n"])
            yield out.assign(doc_id=pdf["doc_id"].to_numpy(), page=None, load=None, **{c: pdf[c].to_numpy() for c in other})[
                ["doc_id", "h1", "h2", "n", "page", "load", *other]]
        pages = total.reshape(-1, PAGE)
        used = np.flatnonzero(pages.any(axis=1))
        load = [zlib.compress(np.minimum(pages[k], 65535).astype(np.uint16).tobytes(), 1) for k in used]
        yield pd.DataFrame({"doc_id": None, "h1": 0, "h2": 0, "n": 0, "page": used, "load": load} | {c: 0 for c in other})

    def added(batches):
        now = total = None
        for pdf in batches:
            for page, raw in zip(pdf["page"], pdf["load"]):
                if page != now:
                    if now is not None:
                        yield pd.DataFrame({"page": [now], "level": [_level(total).tobytes()]})
                    now, total = page, np.zeros(PAGE, np.int64)
                total += np.frombuffer(zlib.decompress(raw), np.uint16)
        if now is not None:
            yield pd.DataFrame({"page": [now], "level": [_level(total).tobytes()]})

    kind = dict(docs.dtypes)["doc_id"]
    every = staged(docs.withColumn("doc_id", F.col("doc_id").cast("string")).select("doc_id", "text", *other).mapInPandas(run, schema), "jaccard-rows", keep=True)
    load = np.zeros(BUCKETS, np.uint8)
    pages = every.where("page IS NOT NULL").select("page", "load").repartition("page").sortWithinPartitions("page")
    for r in pages.mapInPandas(added, "page int, level binary").collect():
        load[r["page"] * PAGE:(r["page"] + 1) * PAGE] = np.frombuffer(r["level"], np.uint8)
    return every.where("page IS NULL").select(F.col("doc_id").cast(kind).alias("doc_id"), "h1", "h2", "n", *other), load


def distinct_sets(docs: DataFrame, load: np.ndarray, words: int, percent: int) -> DataFrame:
    """rid, h1, h2, n, doc (the smallest doc_id), prefix (the shingles whose trees the set
    joins) and bits (its token bitmap): one row per different set that is not empty."""
    rank = docs.sparkSession.sparkContext.broadcast(load)

    def sets(batches):
        load = rank.value
        for pdf in slices(batches, chars=CHARS):
            rows = []
            for doc, s in zip(pdf["doc_id"], shingle_sets(pdf["text"], words)):
                if len(s):
                    p = len(s) - (percent * len(s) + 99) // 100 + 1
                    order = np.argsort(load[_bucket(s)], kind="stable")    # ties: by hash
                    rows.append((doc, *_set_hash(s), len(s), s[order[:p]].view(np.int64), _bitmap(s).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "h1", "h2", "n", "prefix", "bits"])

    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text") \
        .mapInPandas(sets, "doc_id string, h1 long, h2 long, n long, prefix array<long>, bits binary")
    found = found.groupBy("h1", "h2", "n").agg(F.min(F.col("doc_id").cast(kind)).alias("doc"), F.first("prefix").alias("prefix"),
                                               F.first("bits").alias("bits"), F.count(F.lit(1)).alias("copies"))
    return staged(found.withColumn("rid", F.monotonically_increasing_id()), "jaccard-reps")


def _filter_bits(rows: DataFrame, column: str) -> bytes:
    """A bitmap (``FILTER_BITS`` bits, whatever the rows) with a bit for every value of ``column``."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS))
    pages = rows.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 32768).alias("page")) \
        .agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits")).collect()
    out = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for r in pages:
        out[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def _may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % FILTER_BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def shared_trees(reps: DataFrame) -> DataFrame:
    """t, rid, c, lo: the members of every tree of two or more sets, one tree for equal memberships."""
    stats = reps.select("rid", F.explode("prefix").alias("t")).groupBy("t").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rid")).alias("x"), F.bit_xor(F.xxhash64("rid", F.lit(3))).alias("y"),
        F.min("rid").alias("lo")).where("c > 1")
    trees = staged(stats.groupBy("c", "x", "y", "lo").agg(F.min("t").alias("t")).select("t", "c", "lo"), "jaccard-roots")
    wanted = reps.sparkSession.sparkContext.broadcast(_filter_bits(trees, "t"))

    def postings(batches):                           # only shingles that may root a tree are shuffled again
        bits = np.frombuffer(wanted.value, np.uint8)
        for pdf in batches:
            t = np.concatenate([np.asarray(p, np.int64) for p in pdf["prefix"]] or [np.zeros(0, np.int64)])
            rid = np.repeat(pdf["rid"].to_numpy(), [len(p) for p in pdf["prefix"]])
            ok = _may_hold(bits, t)
            yield pd.DataFrame({"t": t[ok], "rid": rid[ok]})

    found = reps.select("rid", "prefix").mapInPandas(postings, "t long, rid long")
    return staged(found.join(trees, "t").select("t", "rid", "c", "lo"), "jaccard-trees")


def stars(members: DataFrame) -> DataFrame:
    """a, b: every member with one pivot.  An original among its altered copies shares more
    shingles with them than they do with each other, so the member of most trees is the best
    centre of a tree; a member goes to that centre with which it shares most trees."""
    degree = members.groupBy("rid").agg(F.count(F.lit(1)).alias("d"))
    best = members.join(degree, "rid").groupBy("t").agg(F.max(F.struct("d", (-F.col("rid")).alias("r"))).alias("m")) \
        .select("t", (-F.col("m.r")).alias("a"))
    shared = members.join(best, "t").where("rid <> a").groupBy("rid", "a").agg(F.count(F.lit(1)).alias("k"))
    one = shared.groupBy("rid").agg(F.max(F.struct("k", (-F.col("a")).alias("r"))).alias("m")).select((-F.col("m.r")).alias("a"), F.col("rid").alias("b"))
    return one.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")


def possible(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps do not rule out."""
    @F.pandas_udf("boolean")
    def open_(n: pd.Series, m: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_possible(*row, percent) for row in zip(n, m, x, y)], dtype=bool)

    left, right = (signed.select(F.col("rid").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}")) for k in "ab")
    return staged(pairs.join(right, "b").join(left, "a").where(open_("na", "nb", "bitsa", "bitsb")).select("a", "b"), "jaccard-possible")


def _possible(n: int, m: int, x: bytes, y: bytes, percent: int) -> bool:
    if 100 * min(n, m) < percent * max(n, m):
        return False
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(x) > len(y):
        n, m, x, y = m, n, y, x
    y = np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)       # a token's bit is its hash modulo the width
    common, lost = int(np.bitwise_count(x & y).sum()), n - int(np.bitwise_count(x).sum())
    return min(n, m, common + lost) >= needed_overlap(n, m, percent)


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """h1, h2, tokens (sorted): every different set of ``docs`` with an h1 of ``wanted``, and a
    few others.  The sets are hashed from the texts again; a fixed-size bitmap of the wanted
    ones drops most others at once."""
    kept = docs.sparkSession.sparkContext.broadcast(_filter_bits(wanted, "h1"))

    def tokens(batches):
        bits = np.frombuffer(kept.value, np.uint8)
        for pdf in slices(batches, chars=CHARS):
            rows = []
            for s in shingle_sets(pdf["text"], words):
                if len(s):
                    h1, h2 = _set_hash(s)
                    if _may_hold(bits, np.array([h1]))[0]:
                        rows.append((h1, h2, s.tobytes()))
            yield pd.DataFrame(rows, columns=["h1", "h2", "tokens"])

    found = docs.select("text").mapInPandas(tokens, "h1 long, h2 long, tokens binary")
    return found.groupBy("h1", "h2").agg(F.first("tokens").alias("tokens"))


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough, by their whole sets.

    The sets are dealt to the pairs' groups: a, cut so that a group has at most about
    ``GROUP`` partners.  A task streams a group: first a's shingles, then each partner.
    """
    if not pairs.limit(1).count():
        return pairs
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("k"))
    salts = F.ceil(F.col("k") / GROUP).cast("int")
    first = many.select(F.col("a").alias("rid"), "a", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("role"))
    rest = pairs.join(many, "a").select(F.col("b").alias("rid"), "a", F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt"),
                                        F.lit(1).alias("role"))
    places = first.unionByName(rest).join(reps.select("rid", "h1", "h2"), "rid")
    places = staged(places, "jaccard-places")
    found = full_sets(docs, places, words)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.join(places, ["h1", "h2"]).select("a", "salt", "role", "rid", "tokens") \
        .repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", "role")

    def compare(batches):
        now = base = None
        for pdf in batches:
            out = []
            for a, salt, role, rid, raw in zip(pdf["a"], pdf["salt"], pdf["role"], pdf["rid"], pdf["tokens"]):
                s = np.frombuffer(raw, np.uint64)
                if role == 0:
                    now, base = (a, salt), s
                elif now == (a, salt) and similar(base, s, percent):
                    out.append((a, rid))
            yield pd.DataFrame(out, columns=["a", "b"])

    return staged(dealt.mapInPandas(compare, "a long, b long"), "jaccard-links")


def similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(p) > len(q):
        p, q = q, p
    if 100 * len(p) < percent * len(q):
        return False
    both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
    return 100 * both >= percent * (len(p) + len(q) - both)


def _width(n: int) -> int:
    """Bits of the bitmap of n tokens: a power of two, at least four a token."""
    return 1 << max(6, int(4 * n - 1).bit_length())


def _bitmap(s: np.ndarray) -> np.ndarray:
    width = _width(len(s))
    bits = np.zeros(width, np.uint8)
    bits[(s & _U(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


class _Side:
    """Signature tree over members with bitmaps of one width; level 0 are the members."""

    def __init__(self, bits: np.ndarray, size: np.ndarray, label: np.ndarray):
        loss = size - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, size, size, loss, label, label)]
        while len(self.levels[-1][0]) > FAN:
            b, lo, hi, ls, l0, l1 = self.levels[-1]
            at = np.arange(0, len(b), FAN)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.maximum.reduceat(ls, at), np.minimum.reduceat(l0, at), np.maximum.reduceat(l1, at)))


def traverse(x: _Side, y: _Side, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Member pairs of two trees that no bound rules out."""
    top = max(len(x.levels), len(y.levels)) - 1
    at = lambda side, k: side.levels[min(k, len(side.levels) - 1)]     # a lower tree waits at its top
    i, j = (a.ravel() for a in np.meshgrid(np.arange(len(at(x, top)[0])), np.arange(len(at(y, top)[0])), indexing="ij"))
    for level in range(top, -1, -1):
        (bx, lx, hx, sx, fx, gx), (by, ly, hy, sy, fy, gy) = at(x, level), at(y, level)
        ok = (100 * hx[i] >= percent * ly[j]) & (100 * hy[j] >= percent * lx[i])
        ok &= ~((fx[i] == gx[i]) & (fy[j] == gy[j]) & (fx[i] == fy[j]))
        i, j = i[ok], j[ok]
        keep = np.zeros(len(i), bool)
        step = max(1, (1 << 20) // bx.shape[1])
        for s in range(0, len(i), step):
            p, q = i[s:s + step], j[s:s + step]
            common = np.bitwise_count(bx[p] & by[q]).sum(1, dtype=np.int64)
            most = np.minimum(common + np.minimum(sx[p], sy[q]), np.minimum(hx[p], hy[q]))
            keep[s:s + step] = most >= needed_overlap(lx[p], ly[q], percent)
        i, j = i[keep], j[keep]
        if level:
            di, dj = (FAN if level < len(side.levels) else 1 for side in (x, y))
            oi, oj = (a.ravel() for a in np.meshgrid(np.arange(di), np.arange(dj), indexing="ij"))
            i, j = (i[:, None] * di + oi).ravel(), (j[:, None] * dj + oj).ravel()
            inside = (i < len(at(x, level - 1)[0])) & (j < len(at(y, level - 1)[0]))
            i, j = i[inside], j[inside]
    return i, j


def _tree_pairs(rid, size, label, bits, side, percent: int):
    """Candidate pairs of one task: members on side 0 against side 1 (2: on both)."""
    width = np.array([len(b) for b in bits])
    order = np.lexsort((rid, size))
    made: dict = {}

    def tree(which, w, as_w):
        key = which, w, as_w
        if key not in made:
            rows = order[(width[order] == w) & ((side[order] == which) | (side[order] == 2))]
            m = np.stack([np.frombuffer(bits[k], np.uint8) for k in rows]).view(np.uint64) if len(rows) else None
            if m is not None and as_w < w:                          # fold: the bit of a token is its hash modulo the width
                m = np.bitwise_or.reduce(m.reshape(len(rows), w // as_w, as_w // 8), axis=1)
            made[key] = rows, _Side(m, size[rows], label[rows]) if m is not None else None
        return made[key]

    for w in np.unique(width):
        for v in (w, 2 * w):
            for p, q in ((0, 1), (1, 0)) if v != w else ((0, 1),):
                (rx, x), (ry, y) = tree(p, w, w), tree(q, v, w)
                if x is None or y is None:
                    continue
                i, j = traverse(x, y, percent)
                a, b = rx[i], ry[j]
                ok = (label[a] != label[b]) & (rid[a] != rid[b])
                yield rid[a[ok]], rid[b[ok]]


def open_members(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` (t, rid, c, n, label) of trees with several classes.  In a tree of one block a
    row also needs another one of a fitting size, which is then next to it by size."""
    small, large = rows.where(F.col("c") <= BLOCK), rows.where(F.col("c") > BLOCK)
    tree = Window.partitionBy("t")
    by_size = tree.orderBy("n", "rid")
    fits = (F.lag("n").over(by_size) * 100 >= F.col("n") * percent) | (F.col("n") * 100 >= F.lead("n").over(by_size) * percent)
    small = small.withColumn("fits", fits).withColumns({"l0": F.min("label").over(tree), "l1": F.max("label").over(tree)}) \
        .where("fits AND l0 <> l1").select(*rows.columns)
    mixed = large.groupBy("t").agg(F.min("label").alias("l0"), F.max("label").alias("l1")) \
        .where("l0 <> l1").select("t")
    return small.unionByName(large.join(mixed, "t", "left_semi"))


def _forest(rid: np.ndarray, pairs):
    """A spanning forest of the ``pairs`` (arrays of ends in ``rid``, as they come): a, b of
    those that join what was not joined, one fewer than ``rid`` at most."""
    ids = np.unique(rid)
    root = np.arange(len(ids))
    for a, b in pairs:
        i, j = np.searchsorted(ids, a), np.searchsorted(ids, b)
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        cuts = np.flatnonzero(np.diff(i, prepend=-1, append=-1)).tolist() if len(i) else []
        for start, end in zip(cuts, cuts[1:]):
            at, to = i[start], j[start:end]
            roots, first = np.unique(root[to], return_index=True)
            new = roots != root[at]
            if new.any():
                yield np.repeat(ids[at], new.sum()), ids[to[first[new]]]
                root[np.isin(root, roots)] = root[at]


def candidate_groups(members: DataFrame, signed: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """rid, n, label, g: the sets that pairs of different classes within a tree, not ruled out
    by a bound of the traversal, still join, and their group.  A task hands on a spanning
    forest of the pairs it finds, not the pairs.  ``members``: t, rid, c; ``signed``: rid, n,
    bits; ``known``: rid, label."""
    sized = signed.select("rid", "n").join(known, "rid", "left").select("rid", "n", F.coalesce("label", "rid").alias("label"))
    rows = staged(members.select("t", "rid", "c").join(sized, "rid"), "jaccard-labelled")
    rows = staged(open_members(rows, percent), "jaccard-mixed")
    per_class = rows.groupBy("t", "label").agg(F.count(F.lit(1)).alias("cl"))
    # blocks: a large class is cut by itself, small ones are dealt together
    blocks = F.ceil(F.col("c") / BLOCK)
    salt = F.pmod(F.xxhash64("rid"), F.ceil(F.col("cl") / BLOCK))
    rows = rows.join(per_class, ["t", "label"]).withColumn(
        "block", F.when(blocks <= 1, F.lit(0).cast("long")).when(F.col("cl") > BLOCK, F.xxhash64("label", salt))
        .otherwise(F.pmod(F.xxhash64("label"), blocks)))
    rows = staged(rows.select("t", "rid", "n", "label", "block"), "jaccard-blocks")
    node = rows.groupBy("t", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("label").alias("l0"),
                                          F.max("label").alias("l1"))
    other = node.select("t", *[F.col(c).alias(f"o_{c}") for c in ("block", "lo", "hi", "l0", "l1")])
    meet = node.join(other, "t").where("block <= o_block AND NOT (l0 = l1 AND o_l0 = o_l1 AND l0 = o_l0)") \
        .where((F.col("hi") * 100 >= F.col("o_lo") * percent) & (F.col("o_hi") * 100 >= F.col("lo") * percent))
    meet = staged(meet.select("t", "block", "o_block"), "jaccard-meet")
    one = meet.select("t", "block", F.col("block").alias("p"), F.col("o_block").alias("q"),
                      F.when(F.col("block") == F.col("o_block"), 2).otherwise(0).alias("side"))
    two = meet.where("block <> o_block").select("t", F.col("o_block").alias("block"), F.col("block").alias("p"),
                                                F.col("o_block").alias("q"), F.lit(1).alias("side"))
    dealt = rows.join(one.unionByName(two), ["t", "block"]).select("t", "p", "q", "side", "rid", "n", "label")
    dealt = dealt.join(signed.select("rid", "bits"), "rid")

    def forest(pdf):
        cols = [pdf[c].to_numpy() for c in ("rid", "n", "label")]
        found = list(_forest(cols[0], _tree_pairs(*cols, pdf["bits"].tolist(), pdf["side"].to_numpy(), percent)))
        if found:
            yield pd.DataFrame({"a": np.concatenate([a for a, _ in found]), "b": np.concatenate([b for _, b in found])})

    edges = staged(grouped(dealt, ["t", "p", "q"], forest, "a long, b long"), "jaccard-forest")
    group = components(edges).select(F.col("node").alias("rid"), F.col("label").alias("g"))
    return staged(group.join(sized, "rid"), "jaccard-groups")


def _joining(label: np.ndarray, side: np.ndarray, sets: list, percent: int):
    """Links (i, j) from side 0 to side 1 (2: on both) that join the classes as all links would.

    Every link shares one of the first shingles of both sets, rarest here first; only those
    that do are compared, and only where their classes are not yet joined."""
    label, size = label.copy(), np.array([len(s) for s in sets])
    row, begin = np.repeat(np.arange(len(sets)), size), np.concatenate([[0], np.cumsum(size)])
    kinds, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ids = ids[np.lexsort((ids, np.bincount(ids)[ids], row))]
    first = size - (percent * size + 99) // 100 + 1
    posted = (np.arange(len(ids)) - begin[row] < first[row]) & (side[row] != 0)
    order = np.argsort(ids[posted], kind="stable")
    post, cut = row[posted][order], np.searchsorted(ids[posted][order], np.arange(len(kinds) + 1))
    have = np.zeros(len(kinds), np.int64)
    for i in np.flatnonzero(side != 1).tolist():
        mine = ids[begin[i]:begin[i + 1]]
        j = np.unique(np.concatenate([post[cut[k]:cut[k + 1]] for k in mine[:first[i]].tolist()]))
        j = j[(label[j] != label[i]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))]
        if not len(j):
            continue
        have[mine] = 1
        starts = np.cumsum(size[j]) - size[j]
        every = ids[np.arange(size[j].sum()) + np.repeat(begin[j] - starts, size[j])]
        both = np.add.reduceat(have[every], starts)
        have[mine] = 0
        for k in j[100 * both >= percent * (size[i] + size[j] - both)].tolist():
            if label[k] != label[i]:
                yield i, k
                label[label == label[k]] = label[i]


def links_within(groups: DataFrame, docs: DataFrame, reps: DataFrame, words: int, percent: int, tokens: int | None = None) -> DataFrame:
    """a, b: links that join the classes of a group exactly as all its links would.  The sets
    of a group are dealt in blocks of about ``tokens`` shingles (``TOKENS``), and two blocks are
    compared in a task."""
    placed = staged(in_blocks(groups, "g", F.col("n"), tokens or TOKENS), "jaccard-placed")
    named = reps.select("rid", "h1", "h2").join(placed.select("rid"), "rid")
    sets = full_sets(docs, named, words).join(named, ["h1", "h2"]).select("rid", "tokens")
    dealt = block_pairs(placed, "g", percent).join(sets, "rid").select("g", "p", "q", "side", "rid", "label", "tokens")

    def confirm(pdf):
        rid, side, label = (pdf[c].to_numpy() for c in ("rid", "side", "label"))
        out = [(int(rid[i]), int(rid[k])) for i, k in _joining(label, side, [np.frombuffer(x, np.uint64) for x in pdf["tokens"]], percent)]
        if out:
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return staged(grouped(dealt, ["g", "p", "q"], confirm, "a long, b long"), "jaccard-joins")


def similarity_classes(docs: DataFrame, words: int = 4, percent: int = 85, carry: tuple = ()) -> DataFrame:
    """doc_id, h1, h2, label (of the class; null for an empty set), n_shingles and component_id
    for every document, and its columns ``carry`` (longs)."""
    bounded_batches(docs.sparkSession)
    with scratch():
        texts = docs.select("doc_id", "text")
        rows, load = hashed_rows(docs.select("doc_id", "text", *carry), words)
        reps = distinct_sets(texts, load, words, percent)
        members = shared_trees(reps)
        signed = reps.select("rid", "n", "bits")
        links = verified(possible(stars(members), signed, percent), texts, reps, words, percent)
        label = F.coalesce("label", "rid").alias("label")
        known = components(links).withColumnRenamed("node", "rid")
        groups = candidate_groups(members, signed, known, percent)
        if groups.limit(1).count():
            links = links.unionByName(links_within(groups, texts, reps, words, percent))
        final = components(links).withColumnRenamed("node", "rid")
        classes = staged(reps.select("h1", "h2", "n", "doc", "copies", "rid").join(final, "rid", "left").select("h1", "h2", "n", "doc", "copies", label),
                         "jaccard-classes")
        named = classes.groupBy("label").agg(F.min("doc").alias("component"))
        classes = classes.join(named, "label").select("h1", "h2", "n", "copies", "label", "component")
        found = with_classes(rows, classes)
    return found.select("doc_id", "h1", "h2", "label", F.col("n").alias("n_shingles"),
                                              F.coalesce("component", "doc_id").alias("component_id"), *carry)


def with_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` (h1, h2, n, ...) with the label and component of their set (null for n = 0).

    A set that holds over a thousandth of all rows is one of less than a thousand, so those are
    broadcast and no task holds the rows of such a set; the others meet by a shuffle."""
    key = ["h1", "h2", "n"]
    classes = staged(classes, "classes-named", keep=True)
    total = rows.count()
    hot = F.broadcast(classes.where(F.col("copies") * 1000 > total).select(*key, F.col("label").alias("__l"), F.col("component").alias("__c"), F.lit(True).alias("__hot")))
    split = rows.join(hot, key, "left")
    none = split.where("__hot IS NULL AND n = 0")
    few = split.where("__hot IS NULL AND n > 0").drop("__l", "__c", "__hot").join(classes.drop("copies"), key, "left")
    done = [d.drop("__hot").withColumnsRenamed({"__l": "label", "__c": "component"}) for d in (none, split.where("__hot"))]
    return few.unionByName(done[0]).unionByName(done[1])


def one_of_each_class(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every class: the one with the smallest doc_id (a null id
    only if there is no other; of rows that repeat it, the one whose set hashes lowest; of
    equal rows, any).  Rows with empty sets are linked with nothing and all stay.

    Texts are not shuffled for it: a list of ids is.  Where ids repeat or are null, the rows
    are staged with a number of their own first."""
    if not docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").limit(1).count():
        gone = similarity_classes(docs, words, percent).where("n_shingles > 0 AND doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
        return docs.join(staged(gone, "jaccard-gone"), F.col("doc_id") == F.col("__gone"), "left_anti")
    number = "__row"
    while number in docs.columns:
        number += "_"
    rows = staged(docs.withColumn(number, F.monotonically_increasing_id()), "jaccard-numbered")
    found = staged(similarity_classes(rows, words, percent, (number,)).where("n_shingles > 0").select("doc_id", "h1", "h2", "label", number), "jaccard-found")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2", number)
    kept = found.groupBy("label").agg(F.min(order)[number].alias(number))
    return rows.join(staged(found.select(number).join(kept, number, "left_anti"), "jaccard-gone"), number, "left_anti").select(*docs.columns)
