"""Cover trees and hard negatives against brute force."""
import math

import numpy as np
import pytest

from geoprep.llm import hard_negatives as H

ROW = "vec_id long, embedding array<double>, label int, uid string, seq int, dim string"        # with clashing extra columns


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, "y") for i, v, lab in rows], ROW)


def brute(rows, step=50, positives=5, negatives=3):
    use = [(u, i, np.floor(256 * np.array(v)).astype(int), (lab + 1) % 10 if i % 7 == 0 else lab) for u, (i, v, lab) in enumerate(rows)
           if i is not None and v is not None and lab is not None and None not in v and np.isfinite(v).all()]
    out = []
    for u, i, v, lab in use:
        if i % step == 0:
            scored = sorted((-int(v @ w), j, other) for t, j, w, other in use if t != u and len(w) == len(v))
            for p, j, other in [x for x in scored if x[2] == lab][:positives]:
                found = [(s, n) for s, n, o in scored if o != lab and 50 * -p <= 100 * -s <= 95 * -p][:negatives]
                out += [(i, j, r, n, -p, -s) for r, (s, n) in enumerate(found, 1)]
    return sorted(out)


def clustered(seed, n, dim=6, clusters=9, spread=0.05):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.4, (clusters, dim))
    return [(i, [float(x) for x in (centres[i % clusters] + r.normal(0, spread, dim)).round(2)], int(r.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("block, panel", [(1024, 8 << 20), (40, 700)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block, panel):
    monkeypatch.setattr(H, "PANEL_BYTES", panel)
    rows = clustered(1, 500)
    rows += [(1000 + i, rows[3][1], 2) for i in range(60)]                              # one vector many times, ties
    rows += [(50, rows[50][1], 1), (50, rows[50][1], 1), (100, [0.0] * 6, 3)]           # repeated ids, a zero vector
    rows += [(150, None, 1), (200, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (250, [float("nan")] * 6, 1), (300, rows[0][1], None), (None, rows[0][1], 1)]
    rows += [(350 + 50 * i, [1.0 + i, -2.0], i % 2) for i in range(8)] + [(9000, [], 1), (9050, [], 2)]
    df = frame(spark, rows)
    got = sorted(map(tuple, H.mine(df, block=block).collect()))
    assert got == brute(rows) and len(got) > 50
    assert H.mine(df.where("false")).count() == 0
    assert H.mine(df.where("vec_id % 50 <> 0")).count() == 0


def test_cover_tree_invariants():
    x = np.floor(256 * np.array([v for _, v, _ in clustered(2, 400)])).astype(np.int64)
    x = np.vstack([x, np.repeat(x[:1], 30, 0)])
    m = float(np.sqrt((x.astype(float) ** 2).sum(1)).max()) * (1 + 1e-12)
    tree = H.CoverTree(x, m)
    assert np.allclose((tree.points ** 2).sum(1), m * m)
    below = [None] * len(tree.centre)
    for n in reversed(range(len(tree.centre))):
        kids = range(tree.first[n], tree.upto[n])
        below[n] = tree.rows[tree.begin[n]:tree.end[n]].tolist() if not len(kids) else sum((below[c] for c in kids), [])
        d = tree._from(tree.centre[n], np.array(below[n]))
        assert math.isclose(d.max(), tree.radius[n], abs_tol=1e-9)                       # the covering radius is reached
        if len(kids):
            c = tree.centre[list(kids)]
            assert c[0] == tree.centre[n]                                               # nesting
            gaps = [np.sort(tree._from(k, c))[1] for k in c]
            assert min(gaps) > tree.radius[n] / 2 and max(tree.radius[k] for k in kids) <= tree.radius[n] / 2 + 1e-9
    assert sorted(below[0]) == list(range(len(x)))


def test_search_opens_few_nodes_where_vectors_cluster():
    r = np.random.default_rng(3)
    centres = r.normal(0, 1, (64, 8))
    x = np.floor(256 * (centres[r.integers(0, 64, 1500)] + r.normal(0, 0.02, (1500, 8)))).astype(np.int64)
    m = float(np.sqrt((x.astype(float) ** 2).sum(1)).max()) * (1 + 1e-12)
    tree, uid = H.CoverTree(x, m), np.arange(1500)
    opened = 0
    for a in range(0, 1500, 50):
        heap = []
        opened += tree.search(x[a].astype(float), [(H.LOWEST, H.HIGHEST)], 5, [heap], uid, uid, a, x)
        s = x @ x[a]
        want = sorted(((-int(s[j]), j) for j in range(1500) if j != a))[:5]
        assert sorted((-s, -v) for s, v, _ in heap) == want
    assert opened < 30 * len(tree.centre) / 5
