"""BPE against the tokenizers library, by exact ids and decoded texts."""

import random

import numpy as np
import pytest

from threadmill.llm import bpe
from threadmill.llm.queries import vocabulary_file


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    return bpe.Encoder(bpe.Vocabulary(vocabulary_file())), Tokenizer.from_file(vocabulary_file())


def same(both, texts):
    ours, theirs = both
    ids, decoded = ours.encode(texts)
    for t, i, d in zip(texts, ids, decoded):
        want = theirs.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(i, "<u4").tolist() == want, t
        assert d == theirs.decode(want, skip_special_tokens=False), t


def test_written_cases(both):
    same(both, ["", " ", "Hello World's it'll 12345 !!?? 'S 'LL don't I'M '' 's", "ñandú ΑΣ ΣΑΣ İstanbul ſ K ẞ ﬁ ǅ １２ ⅷ ½ 漢字 한글",
                "x<|endoftext|>y <|startoftext|> <|endof <|ENDOFTEXT|>", "a\x1cb\x85c d　e\x00f", "a" * 5000, "ab" * 3000 + "'", "👍🏽 é é"])


def test_random_texts(both):
    rng = random.Random(7)
    alpha = "aabcdeeehiilmnoorsttu'éß #$12\n\tΣσß漢👍İ"
    same(both, ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 60))) for _ in range(1500)])


def test_exact_merging_and_pairs(both):
    """The batch merge and the pair test agree with each other on random token pairs."""
    v = both[0].v
    rng = np.random.default_rng(2)
    shown = [t for t, _ in v.proposals if ord(t[-1]) < bpe.END]
    ids = dict(v.proposals)
    a, b = ([shown[i] for i in rng.integers(0, len(shown), 3000)] for _ in range(2))
    ok = v.compatible(np.array([ids[x] for x in a]), np.array([ids[x] for x in b]))
    flat, counts = v.merge([x + y for x, y in zip(a, b)])
    at = np.concatenate(([0], np.cumsum(counts)))
    want = [flat[at[i] : at[i + 1]].tolist() == [ids[a[i]], ids[b[i]]] for i in range(len(a))]
    assert ok.tolist() == want and 0 < ok.mean() < 1


def test_frames(spark, docs_of, both, monkeypatch):
    monkeypatch.setattr(bpe, "VOCAB_WORDS", 5)
    rows = [(1, None, "x", "y"), (1, "", "x", "y"), (None, "Hello there", "x", None), (2, "Hello there", "x", "y"), (2, "Hello there", "x", "y")]
    frame = docs_of(rows=rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "N_TOKENS")
    out, n, ids, decoded = bpe.encode_documents(frame, vocabulary_file())
    assert out.columns[:4] == frame.columns and len(set(map(str.lower, out.columns))) == 7
    got = sorted((str(r["doc_id"]), r[n], r[decoded]) for r in out.collect())
    assert got == sorted([("1", 0, ""), ("1", 0, ""), ("None", 2, "hello</w> there</w>"), ("2", 2, "hello</w> there</w>"), ("2", 2, "hello</w> there</w>")])
    assert bpe.encode_documents(docs_of(rows=[]), vocabulary_file())[0].count() == 0
