"""op13: whole results against brute force; the bounds really bound; pruning really skips."""
import math
import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from quotelake.llm.hard_negatives import (AnchorTree, Candidates, MiningRules, depth_first, hard_negatives, positives_in,  # noqa: E402
                                          products, score_range, spanning_tree, walk)

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, cell int, block string, team int, score string, k int, edge string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, "b", 2, "s", 3, "e") for r in rows], SCHEMA)


def brute(rows, every=50, flip=7):
    keep = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        label = (label + 1) % 10 if i % flip == 0 else label
        keep[(i, label, tuple(int(math.floor(256 * v)) for v in x))] = 1
    keep = list(keep)
    out = []
    for a in [r for r in keep if r[0] % every == 0]:
        scored = [(-sum(p * q for p, q in zip(a[2], c[2])), c[0], c[1]) for c in keep if c[0] != a[0] and len(c[2]) == len(a[2])]
        scored.sort()
        for p in [s for s in scored if s[2] == a[1]][:5]:
            negatives = [n for n in scored if n[2] != a[1] and 50 * -p[0] <= 100 * -n[0] <= 95 * -p[0]][:3]
            out += [(a[0], p[1], k + 1, n[1], -p[0], -n[0]) for k, n in enumerate(negatives)]
    return sorted(out)


def mined(df, rules=MiningRules()):
    return sorted(tuple(r) for r in hard_negatives(df, rules).collect())


def vectors(seed=0, n=400, dim=6, labels=4):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(v) for v in rng.normal(size=dim)], int(rng.integers(0, labels))) for i in range(n)]


AWKWARD = [(None, [0.1] * 6, 1), (5000, None, 1), (5050, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (5100, [math.nan] * 6, 1), (5150, [math.inf] * 6, 1),
           (5200, [0.5] * 6, None), (5250, [], 1), (5251, [], 2), (5300, [0.0] * 6, 1), (5350, [1.0, 2.0], 3), (5351, [1.0, 1.5], 3),
           (5352, [1.0, 1.0], 2), (5353, [0.9, 1.0], 2), (-50, [0.3] * 6, 2), (-49, [0.2] * 6, 2), (-48, [0.15] * 6, 3)]


def test_whole_result_with_ties_and_awkward_rows(spark):
    rows = vectors() + AWKWARD
    rows += [(6000 + i, [0.5] * 6, i % 3) for i in range(60)] + rows[:40]          # ties, repeated rows
    rows += [(50, [0.7] * 6, 1)]                                                   # an id with another vector
    assert mined(frame(spark, rows)) == brute(rows)


def test_many_blocks_shards_and_teams_change_nothing(spark):
    rows = vectors(1, 700, 5) + [(7000 + i, [1.0, 0.0, 0.0, 0.0, 0.5], i % 2) for i in range(100)]
    rules = MiningRules(every=3, block_anchors=16, blocks_per_group=3, cells=5, shard_rows=100)
    assert mined(frame(spark, rows), rules) == brute(rows, 3)


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0 ** 40 * (1 + (i % 13) / 16), 3.0 + i, 1.0], i % 2) for i in range(120)]
    want = brute(rows)
    top = 2 ** 63 - 1
    assert mined(frame(spark, rows)) == sorted((a, p, k, n, min(top, s), min(top, t)) for a, p, k, n, s, t in want)
    assert mined(frame(spark, [(50, [1e308], 1), (51, [1e308], 1), (52, [1e307], 2)])) == []       # infinite after scaling


def test_empty(spark):
    assert mined(frame(spark, vectors()[:1]).limit(0)) == [] and mined(frame(spark, [(50, [1.0], 1)])) == []


def tree_of(x, ids=None, labels=None):
    order, parent, edge = spanning_tree(x)
    line = depth_first(order, parent)
    seq = np.empty(len(line), int)
    seq[line] = range(len(line))
    up = np.where(parent >= 0, seq[parent], -1)
    ids = np.arange(len(x)) if ids is None else ids
    labels = np.zeros(len(x), int) if labels is None else labels
    return AnchorTree([int(i) for i in ids[line]], ids[line], labels[line], x[line], up[line], edge[line])


def test_spanning_tree_is_minimal_and_ordered():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(60, 4)) * 100)
    t = tree_of(x)
    assert t.parent[0] == -1 and all(t.parent[i] < i for i in range(60)) and (t.parent[1:] >= 0).all()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    joined, total = {0}, 0.0                                   # Prim by hand
    while len(joined) < 60:
        w, j = min((d[i, j], j) for i in joined for j in range(60) if j not in joined)
        total += w
        joined.add(j)
    assert abs(t.edge[1:].sum() - total) < 1e-3


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(4, 8)) * 200
    anchors = np.floor(np.concatenate([c + rng.normal(size=(30, 8)) for c in centre]))
    x = np.floor(rng.normal(size=(2000, 8)) * 100)
    shard = Candidates(np.arange(2000), np.zeros(2000, int), x)
    t = tree_of(anchors, ids=np.arange(10_000, 10_120))
    looked = 0

    def window(node, low, high):
        s = x @ t.x[node]
        assert (low <= s).all() and (s <= high).all()
        return high >= np.sort(low)[-5]

    for node, at, scores in walk(t, shard, window):
        looked += len(at)
        true = x @ t.x[node]
        assert (scores == true[at]).all() and set(np.argsort(-true, kind="stable")[:5]) <= set(at)
    assert looked < 0.2 * 120 * 2000                           # near anchors let most candidates go unscored
    got = list(positives_in(t, shard, 5))
    assert len(got) == 120 * 5


def test_products_and_ranges():
    x = np.array([[2.0 ** 60, 1.0], [3.0, -2.0]])
    assert list(products(x, np.array([2.0 ** 30, 7.0]))) == [2 ** 90 + 7, 3 * 2 ** 30 - 14]
    for p in (-7, -1, 0, 1, 2, 3, 19, 20, 21, 1001):
        a, b = score_range(p, MiningRules())
        assert [n for n in range(-50, 1200) if 50 * p <= 100 * n <= 95 * p] == list(range(a, b + 1))
