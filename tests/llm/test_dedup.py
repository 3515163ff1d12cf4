"""Near-dedup, substring dedup and line dedup against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from threadmill.llm import minhash_dedup as M
from threadmill.llm import substring_dedup as S
from threadmill.llm.components import components
from threadmill.llm.line_dedup import dedup_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def near_brute(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = words(lower(t))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= percent * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def mutate(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return w


def near_rows():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", "   \n", "one", "ONE", "two words", "a b c", "A b\tC "]
    hot = rng.choices(vocab, k=60)
    for _ in range(25):
        base = rng.choices(vocab, k=rng.randint(20, 120))
        texts.append(" ".join(base))
        for n in (0, 0, 1, 2, 3, 5):
            texts.append(" ".join(mutate(rng, base, n)))
        texts.append(" ".join(hot + rng.choices(vocab, k=rng.randint(5, 60))))
    big = rng.choices(vocab, k=100)  # one large group of near copies around the threshold
    texts += [" ".join(mutate(rng, mutate(rng, big, 2), rng.randint(0, 4))) for _ in range(120)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [60_000, 300])
def test_near_duplicates_equal_brute_force(docs_of, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rows = near_rows()
    got = M.near_duplicates(docs_of(rows=[(d, t, "en", "s") for d, t in rows]), words=4, percent=80).collect()
    want = near_brute(rows, 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    assert len(got) == len(rows)


def test_near_duplicates_defined_results(docs_of):
    text = "the same text here again and again in full"
    rows = [(None, text, "en", "s"), (5, text, "en", "s"), (5, text, "en", "s"), (2, text.upper(), None, None), (9, None, "en", "s")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs_of(rows=rows)).collect()), key=str)
    assert got == sorted([(None, 5, None, True), (5, 5, 2, False), (5, 5, 2, False), (2, 5, 2, True), (9, 0, 9, True)], key=str)
    assert M.near_duplicates(docs_of(rows=[])).count() == 0


def test_signatures_keep_the_threshold():
    """Pairs of similarity 0.8 agree in matches(80) coordinates."""
    rng = np.random.default_rng(1)
    least = M.COORDS
    for _ in range(200):
        x = rng.integers(0, 2**63, 450, dtype=np.uint64)
        sig = [np.array([(s * a).min() >> np.uint64(32) for a in M.A]) for s in (x[:405], x[45:])]
        least = min(least, int((sig[0] == sig[1]).sum()))
    assert least >= M.matches(80) == 34


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    got = components(edges).collect()
    assert len(got) == 301 and {r.component for r in got} == {0}


def substring_brute(rows, k):
    least = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            least[key] = min(least.get(key, d), d)
    out = {}
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - k + 1):
            if least[tuple(w[i : i + k])] < d:
                gone |= set(range(i, i + k))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def substring_rows(seed=0, n=90):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(60)] + ["é", "日本", "A", "a"]
    passages = [rng.choices(vocab, k=rng.randint(10, 70)) for _ in range(6)] + [["x"] * 40, ["p", "q"] * 20]
    texts = [None, "", " \t ", " ".join(["x"] * 13), " ".join(["x"] * 12), "short text"]
    for _ in range(n):
        t = []
        for _ in range(rng.randint(1, 4)):
            t += rng.choices(vocab, k=rng.randint(0, 30))
            if rng.random() < 0.6:
                p = rng.choice(passages)
                t += p[rng.randint(0, 5) : len(p) - rng.randint(0, 5)]
        texts.append(rng.choice([" ", "\n", " \t"]).join(t))
    texts += texts[-3:]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [0, 1])
def test_substrings_equal_brute_force(docs_of, seed):
    rows = substring_rows(seed)
    got = S.dedup_substrings(docs_of(rows=[(d, t, "en", "s") for d, t in rows]), window=13).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == substring_brute(rows, 13)


def test_equal_windows_share_their_key():
    """Whatever stands around a window, it is posted under the same key."""
    rng = random.Random(8)
    vocab = [b"a", b"b", b"c", b"d%d"]
    for _ in range(60):
        win = [rng.choice(vocab) for _ in range(13)]
        keys = set()
        for _ in range(4):
            left = [rng.choice(vocab) for _ in range(rng.randint(0, 9))]
            right = [rng.choice(vocab) for _ in range(rng.randint(0, 9))]
            s = S.Slice([b" ".join(left + win + right)])
            at, _ = s.windows(13)
            keys.add(int(s.keys(at, 13)[len(left)]))
        assert len(keys) == 1


def test_substrings_defined_results(docs_of):
    t = " ".join(f"w{i}" for i in range(20))
    rows = [(None, t, "en", "s"), (4, t, "en", "s"), (4, t, "en", "s"), (7, t + " end", None, None), (8, None, "en", "s")]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in S.dedup_substrings(docs_of(rows=rows)).collect()), key=str)
    assert got == sorted([(None, 20, 0), (4, 20, 0), (4, 20, 0), (7, 21, 20), (8, 0, 0)], key=str)
    assert S.dedup_substrings(docs_of(rows=[])).count() == 0


def line_brute(rows, chars, docs):
    def key(x):
        return lower(x.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= chars and d is not None:
                holders[k].add(d)
    common = {k: max(v) for k, v in holders.items() if len(v) >= docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or d >= common.get(key(x), d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines_equal_brute_force(docs_of):
    rng = random.Random(2)
    pool = ["Licensed under the Apache License", "  licensed UNDER the apache license\t", "ÄÖÜ ünïcode line of twenty", "short", "",
            "exactly twenty chars", "exactly nineteen ch", "\x85kept blank of another kind"]
    rows = [(0, None), (1, ""), (2, "\n\n"), (None, pool[0] + "\nown")]
    for d in range(3, 60):
        rows.append((d, "\n".join(rng.choice([*pool, f"line number {rng.randrange(40)} of the pool"]) for _ in range(rng.randint(1, 8)))))
    rows.append((59, rows[-1][1]))
    frame = docs_of(rows=[(d, t, "en", "s") for d, t in rows]).withColumnRenamed("lang", "n_lines").withColumnRenamed("source", "Dropped_Keys")
    out, n, dropped = dedup_lines(frame)
    assert out.columns == ["doc_id", "text", "n_lines", "Dropped_Keys", n, dropped] and n != "n_lines"
    got = [(r["doc_id"], r[n], r[dropped], r["text"] or "") for r in out.collect()]
    assert sorted(got, key=str) == sorted(line_brute(rows, 20, 3), key=str)
    assert dedup_lines(docs_of(rows=[]))[0].count() == 0
