"""Ranked lexical search against brute force; best positions against last-read positions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from threadmill.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(docs, items, k):
    docs = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if d is not None]
    n_docs, n_terms = sum(n > 0 for *_, n in docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    texts = {}
    for i, t in items:
        if i is not None and t is not None:
            texts[i] = min(texts.get(i, t), t)
    out = []
    for i, t in texts.items():
        scored = []
        for d, c, n in docs:
            s = 0
            for term in terms(t):
                if c[term]:
                    m = 100 - 75 + (75 * n * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    s += w * ((10**9 * c[term]) // (1000 * c[term] + 8 * m))
            if s > 0:
                scored.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(120)] + ["The", "ñandú", "日本", "x²", "É", "a_b", "don't"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(vocab, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    docs += [(5000 + i, "the same text of very many documents") for i in range(n // 2)]  # a third, tied
    docs += [(9000, None), (9001, ""), (9002, "\x7f ,.!"), (None, "the w0 w1"), (9003, "w5 " * 50_000), (7, "w0 again")]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 25])))) for i in range(25)]
    items += [(100, "the same text of very many documents"), (101, "absent"), (102, None), (103, ""), (None, "w0"), (104, "w9"), (104, "w8 w8 w8")]
    return docs, items


def run(spark, docs, items, k=10):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("x", "x").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 as score", "2 as doc_id")
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in S.search(d.selectExpr("*", "1 as n", "2 as terms"), q, k).collect())


@pytest.mark.parametrize("shard,block", [(1 << 20, 1 << 18), (300, 1 << 18), (5_000, 20)])
def test_equals_brute_force(spark, monkeypatch, shard, block):
    """One shard and many, one block of queries and many."""
    monkeypatch.setattr(S, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(S, "BLOCK_TERMS", block)
    monkeypatch.setattr(S, "STEP", 8)
    monkeypatch.setattr(S, "PILOT", 16)
    docs, items = corpus()
    assert run(spark, docs, items) == brute(docs, items, 10)


def test_empty_tables(spark):
    docs, items = corpus(n=5)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []


def test_terms_are_those_of_the_pattern():
    texts = ["Aa-bB_c9 é!É x y\x80", "", None, "\x00\x7f", "日本 語z"]
    h, first = S.term_hashes([None if t is None else t.encode() for t in texts])
    assert np.diff(first).tolist() == [len(terms(t)) for t in texts]
    same = [t for x in texts for t in terms(x)]
    assert len({(x, y) for x, y in zip(same, h.tolist())}) == len(set(same)) == len(set(h.tolist()))


def shard_of(rows):
    """rows: {term: {doc: impact}}"""
    flat = [(d, t, i) for t, hits in rows.items() for d, i in hits.items()]
    doc, term, impact = (np.array(x, np.int64) for x in zip(*flat))
    return S.Shard(doc, term, impact, int(doc.max()) + 1)


def test_best_positions_stop_earlier_than_last_read(monkeypatch):
    """Documents met in one list fill the other's next positions, so the bound falls
    below that of the last positions read, and reading stops earlier."""
    monkeypatch.setattr(S, "STEP", 1)
    a = {d: 1000 - d for d in range(40)}
    b = {(d + 1) % 40: 1000 - d for d in range(40)}  # the same order, one step behind
    found, scores, read = shard_of({0: a, 1: b}).search([(0, 1), (1, 1)], 3, 0)
    want = sorted(range(40), key=lambda d: (-(a[d] + b[d]), d))[:3]
    assert set(want) <= set(found.tolist()) and read < 40
    kth = sorted((a[d] + b[d] for d in range(40)), reverse=True)[2]
    last_read = next(i for i in range(40) if sorted(a.values(), reverse=True)[i] + sorted(b.values(), reverse=True)[i] < kth)
    assert read <= last_read + 1


def test_ties_at_the_bound_are_read(monkeypatch):
    """Equal scores beyond the k-th: the search goes on until it is strictly below."""
    monkeypatch.setattr(S, "STEP", 2)
    rows = {0: {d: 500 for d in range(100)}}
    found, scores, read = shard_of(rows).search([(0, 3)], 5, 0)
    assert len(found) == 100 and set(scores.tolist()) == {1500}
    found, _, _ = shard_of(rows).search([(0, 3)], 5, 1501)  # nothing reaches the floor
    assert len(found) == 0


def test_large_numbers_stay_exact():
    assert S.impacts(np.array([3]), np.array([10**9]), 10**11, 10**12).tolist() == [
        (10**9 * 3) // (3000 + 8 * (25 + (75 * 10**9 * 10**11) // 10**12))]
