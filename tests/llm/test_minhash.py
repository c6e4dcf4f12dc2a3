"""MinHash near-duplicate classes against brute force."""
import random
import re
import time

import numpy as np
import pytest

from geoprep.llm import jaccard, minhash as M
from geoprep.llm.components import components

DOC = "doc_id long, text string, n long, sig string, rid int, label string, t int"       # with clashing extra columns
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", 3) for i, t in rows], DOC)


def shingles(text, words):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted([(doc, len(s), low.get(find(i)), doc is not None and doc == low.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets))], key=str)


def texts(seed, groups=12, copies=9):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    common = " ".join(rnd.choices(vocabulary, k=25))                      # a passage that many documents hold
    out = []
    for g in range(groups):
        base = rnd.choices(vocabulary, k=rnd.choice([3, 8, 40, 150]))
        for c in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):         # similarities on both sides of the bound
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            out.append(" ".join(w) + (f" {common}" if g % 3 == 0 else ""))
    return out


@pytest.mark.parametrize("block, tokens", [(1024, 1 << 19), (4, 300)])
def test_classes_equal_brute_force(spark, monkeypatch, block, tokens):
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "TOKENS", tokens)
    t = texts(1) + [None, "", " \n", "a", "A", "a b", "a  B", "a b c", "x" * 70_000, "word " * 20_000, "é É", "é É"]
    t += ["the same words again and again in this text"] * 40
    rows = list(enumerate(t, 3)) + [(3, t[0]), (3, t[5]), (None, t[0]), (None, "all alone here in the dark"), (-5, t[9])]
    got = M.near_duplicate_classes(frame(spark, rows), 3, 85)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 3, 85)


def test_an_empty_table_and_one_without_words(spark):
    assert M.near_duplicate_classes(frame(spark, [(1, "x")]).where("false")).count() == 0
    rows = [(1, None), (2, " "), (3, "")]
    assert sorted(map(tuple, M.near_duplicate_classes(frame(spark, rows)).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_pairs_within_the_reach_always_share_a_key():
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 16, (300, M.SYMBOLS), dtype=np.uint16)
    other = base.copy()
    for k, row in enumerate(other):
        at = r.choice(M.SYMBOLS, size=min(k % (M.REACH + 1), M.REACH), replace=False)
        row[at] += 1 + r.integers(0, 1000, len(at), dtype=np.uint16)
    x, y = M.chunk_keys(base), M.chunk_keys(other)
    assert (x == y).any(1).all()
    assert len(np.unique(x)) == x.size                                     # different chunks and symbols left out are different keys


def test_symbols_agree_as_often_as_the_sets_do():
    r = np.random.default_rng(6)
    every = jaccard._mix(r.integers(0, 1 << 62, 3000, dtype=np.uint64))
    for share in (0.5, 0.85, 0.95):
        agree = []
        for _ in range(60):
            pick = r.permutation(every)[:400]
            cut = int(400 * share / (1 + share) * 2)
            a, b = pick[:200 + cut // 2], pick[200 - cut // 2:]
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = M.signatures([np.sort(a), np.sort(b)])
            agree.append((s[0] == s[1]).mean() - j)
        assert abs(np.mean(agree)) < 0.02


def test_words_that_only_a_weak_hash_confuses_are_told_apart(spark):
    bits = "0"
    while len(bits) < 1024:
        bits += "".join("10"[int(b)] for b in bits)
    a, b = (bits.translate(str.maketrans(x, "ab")) for x in ("01", "10"))   # no polynomial modulo 2^64 tells these apart
    rows = [(1, f"{a} {b} {a} {a}"), (2, f"{b} {a} {b} {b}")]
    assert {r["component_id"] for r in M.near_duplicate_classes(frame(spark, rows)).collect()} == {1, 2}
    assert {r["component_id"] for r in jaccard.similarity_classes(frame(spark, rows)).collect()} == {1, 2}


def test_a_large_group_of_loose_copies_is_not_compared_pair_by_pair(spark):
    rnd, base, rows = random.Random(9), [f"b{k}" for k in range(60)], []
    for i in range(2400):                                                  # each far nearer to all others than chance, but linked with one
        w = list(base)
        for k in range(0, 60, 12):
            w[k + rnd.randrange(2)] = f"x{i // 2}-{k}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w + ["end"]))] if i % 2 == 0 else [(2 * i, " ".join(w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = M.signed_rows(docs, 1).where("n > 0")
    reps = table.select(table["doc_id"].alias("rid"), "h1", "h2", "n", "sig")
    groups = reps.selectExpr("rid", "n", "rid AS label", "0L AS g")
    began = time.time()
    links = M.links_within(groups, docs, reps, 1, 85)
    assert time.time() - began < 50                                        # pair by pair, 6.5 million comparisons took longer
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert all(got[2 * i] == got[2 * i + 1] for i in range(0, 2400, 2))


def test_a_round_of_components_writes_files_for_its_rows_not_for_the_partitions(spark):
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    held = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        links = spark.createDataFrame([(i, i + 1) for i in range(1, 400) if i % 7], "a long, b long")
        got = components(links)
        assert {r["node"]: r["label"] for r in got.collect()} == {k: k - (k - 1) % 7 for k in range(1, 400)}
        assert len(got.inputFiles()) <= spark.sparkContext.defaultParallelism
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
