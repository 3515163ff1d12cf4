"""Exact top-k against brute force."""

import math
import random

import pytest

from threadmill.llm import topk_search as K

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows(n=260, dim=6):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, [x + rng.gauss(0, 0.2) for x in c], 0))
    hot = out[7][1]  # one vector that a third of the rows share
    out += [(1000 + i, hot, 1) for i in range(130)]
    out += [(2000, None, 0), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (2002, [float("nan")] * dim, 0), (2003, [float("inf")] * dim, 0)]
    out += [(None, hot, 0), (2004, [], 0), (2005, [1.5], 0), (20, out[20][1], 3)]
    return out


def brute(data, k, every):
    import struct

    vecs = set()
    for i, v, _ in data:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        f = [struct.unpack("f", struct.pack("f", x))[0] for x in v]
        vecs.add((i, tuple(math.floor(1024 * x) for x in f)))
    queries = {}  # the smallest vector of an id
    for i, v in sorted(vecs):
        if i % every == 0:
            queries.setdefault(i, v)
    out = []
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in vecs if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 4096), (4, 50)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(K, "Q_BLOCK", blocks[0])
    monkeypatch.setattr(K, "ROWS", blocks[1])
    data = rows()
    v = K.integer_vectors(spark.createDataFrame(data, SCHEMA))
    got = K.top_k(v, v.where("vec_id % 20 = 0"), k=10).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(data, 10, 20)


def test_few_rows_and_empty(spark):
    v = K.integer_vectors(spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 2.0], 0)], SCHEMA))
    assert [(r.query_id, r.vec_id, r.score) for r in K.top_k(v, v.where("vec_id = 0")).collect()] == [(0, 1, 1024 * 2048 + 2048 * 2048)]
    e = K.integer_vectors(spark.createDataFrame([], SCHEMA))
    assert K.top_k(e, e).count() == 0


def test_bounds_strike_out_annuli(spark):
    """Far clusters are not visited once ten near rows are known."""
    import numpy as np

    pivots = np.array([[100.0, 0.0, 0.0], [-100.0, 0.0, 0.0]])

    class Ref:
        value = (pivots, 2, 100.0**2, np.array([0, K.RINGS]), np.array([0.0, 0.0]), np.array([1.0, 1.0]))

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"vec_id": [1], "v": [[100, 0]]})
    out = next(K._visits(Ref)([batch])).to_pydict()
    assert out["bound"][0] >= 100 * 100 and out["bound"][1] < -9000


def test_many_vectors_under_a_querys_id(spark):
    """More own rows than k that score best: none is a candidate, none crowds out the others."""
    data = [(100, [10.0 + i, 1.0], 0) for i in range(20)] + [(200 + i, [1.0 + i, 0.0], 0) for i in range(4)]
    v = K.integer_vectors(spark.createDataFrame(data, SCHEMA))
    got = K.top_k(v, v.where("vec_id % 100 = 0"), k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(data, 3, 100)
