"""Hard negatives against brute force; packing and pruning of the R-tree."""

import math
import random

import numpy as np
import pytest

from threadmill.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, v string, tile int"


def rows(n=260, dim=5, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    out = []
    for i in range(n):
        k = rng.randrange(4)
        out.append((i, [x + rng.gauss(0, 0.3) for x in centres[k]], k if rng.random() < 0.8 else 4))
    hot = out[7][1]
    out += [(1000 + i, hot, 1) for i in range(130)]  # one vector and label of a third of all rows
    out += [(2000, None, 0), (2001, [1.0, None, 0.0, 0.0, 0.0], 0), (2002, [float("nan")] * dim, 0), (2003, [math.inf] * dim, 0)]
    out += [(None, hot, 0), (2004, [], 0), (2005, [1.5], None), (20, out[20][1], out[20][2]), (40, [0.5] * dim, 2), (2006, [-x for x in hot], 1)]
    out += [(2010, [0.0] * dim, 3), (60, hot, 9)]  # a label of its own
    return [(*r, "x", 1) for r in out]


def brute(data, every, scale=256, positives=5, negatives=3):
    vecs = set()
    for i, v, label, *_ in data:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        vecs.add((i, label, tuple(math.floor(scale * x) for x in v)))
    anchors = {}
    for i, label, v in sorted(vecs):
        if i % every == 0:
            anchors.setdefault(i, (label, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(v, x)), i, c) for i, c, x in vecs if i != a)
        for s, i, _ in [r for r in scored if r[2] == label][:positives]:
            ok = [(-t, j) for t, j, c in scored if c != label and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(a, i, r + 1, j, -s, t) for r, (t, j) in enumerate(ok)]
    return sorted(out)


def mined(spark, data, every, **kw):
    v = H.labelled_vectors(spark.createDataFrame(data, SCHEMA).repartition(3))
    got = H.mine_negatives(v, v.where(f"vec_id % {every} = 0"), **kw)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


@pytest.mark.parametrize("sizes", [(4096, 1024, 64, 256), (40, 3, 8, 16)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    for name, n in zip(("ROWS", "QUERIES", "LEAF", "TILES"), sizes):
        monkeypatch.setattr(H, name, n)
    data = rows()
    want = brute(data, 20)
    assert len(want) > 50 and mined(spark, data, 20) == want


def test_other_windows_and_few_rows(spark):
    data = rows(n=40)
    assert mined(spark, data, 10, positives=2, negatives=1) == brute(data, 10, positives=2, negatives=1)
    two = [(0, [1.0, 0.0], 0, "", 0), (1, [1.0, 0.0], 0, "", 0), (3, [0.6, 0.0], 1, "", 0)]
    assert mined(spark, two, 10) == brute(two, 10) != []
    assert mined(spark, [], 10) == [] and mined(spark, two[1:], 10) == []
    one = H.labelled_vectors(spark.createDataFrame([(0, [1.0], 0, "", 0)], SCHEMA))
    assert H.mine_negatives(one, one).count() == 0


def test_large_components_stay_exact(spark):
    data = [(i, [float(2**21 + i), float(-(2**20) + 3 * i)], i % 2, "", 0) for i in range(12)]
    data += [(100 + i, [float(2**20 + i), float(-(2**19) + i)], 5, "", 0) for i in range(12)]
    assert mined(spark, data, 3) == brute(data, 3) != []


def test_intervals_hold_every_product():
    rng = np.random.default_rng(0)
    x = rng.integers(-100, 100, (64, 6)).astype(float)
    a = rng.integers(-100, 100, (20, 6)).astype(float)
    least, most = H.intervals(a, x.min(0)[None], x.max(0)[None])
    s = a @ x.T
    assert (least[:, 0] <= s.min(1)).all() and (s.max(1) <= most[:, 0]).all()


def test_queue_prunes_boxes_outside_the_window():
    """Clusters far apart: most leaves are never read, the answer is that of a scan."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-1000, 1000, (40, 4))
    x = (centre[:, None, :] + rng.integers(-5, 6, (40, 100, 4))).reshape(-1, 4).astype(float)
    label = np.repeat(np.arange(40) % 5, 100)
    tree = H.Tree(np.arange(len(x)), label, x)
    assert len(tree.ids) == len(x) and sorted(tree.ids.tolist()) == list(range(len(x)))
    for start, end in tree.leaves:
        assert len(set(tree.label[start:end])) == 1 and end - start <= H.LEAF
    a = x[17]
    least, most = H.intervals(a[None], tree.lo, tree.hi)
    s = (x @ a).astype(int)
    for same, low, high in ((True, -(2**63), 2**63 - 1), (False, int(s.max() * 0.3), int(s.max() * 0.6))):
        (got,), read = tree.search(a, least[0], most[0], 17, int(label[17]), same, [(low, high, -(2**63))], 5)
        fits = [(-s[i], i) for i in range(len(x)) if i != 17 and (label[i] == label[17]) == same and low <= s[i] <= high]
        assert list(zip((-got[0]).tolist(), got[1].tolist())) == sorted(fits)[:5]
        assert read < len(tree.leaves) / 4


def test_tiles_take_every_row_and_follow_labels():
    rng = np.random.default_rng(3)
    x = np.concatenate((rng.integers(0, 4, (2000, 1)), rng.normal(size=(2000, 3))), 1)
    node = H.cut_tiles(x, [0, 1, 2], 16)
    tile = H.tile_of(x, node)
    n = np.bincount(tile)
    assert 8 <= len(n) <= 32 and n.min() > 0 and n.max() < 3 * n.mean()
