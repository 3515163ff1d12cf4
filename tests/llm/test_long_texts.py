"""One text far longer than a slice beside short ones: whole texts, exact counts."""

import random

import pytest
from pyspark.sql import functions as F

from threadmill.llm import minhash_dedup as M
from threadmill.llm import quality_rules as Q
from threadmill.llm import secret_scan as S
from threadmill.llm.bpe import encode_documents
from threadmill.llm.line_dedup import dedup_lines
from threadmill.llm.mixing import sized
from threadmill.llm.queries import vocabulary_file
from threadmill.llm.substring_dedup import dedup_substrings

N = 300_000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = [f"w{rng.randrange(50_000)}" for _ in range(N)]
    lines = [" ".join(words[i : i + 10]) for i in range(0, N, 10)]
    text = "\n".join(lines)
    tail = "\n".join(lines[-4:])
    return [(1, tail, "en", "a"), (2, text, "en", "a"), (3, text, "en", "b"), (4, tail, "en", "b"), (5, "", "en", "b")]


def test_dedup(docs_of, rows):
    d = docs_of(rows=rows)
    near = {r.doc_id: r.component_id for r in M.near_duplicates(d).collect()}
    assert near == {1: 1, 2: 2, 3: 2, 4: 1, 5: 5}
    cut = {r.doc_id: (r.n_words, r.n_removed) for r in dedup_substrings(d).collect()}
    assert cut == {1: (40, 0), 2: (N, 40), 3: (N, N), 4: (40, 40), 5: (0, 0)}
    out, n, dropped = dedup_lines(d)
    got = {r["doc_id"]: (r[n], r[dropped]) for r in out.collect()}
    assert got == {1: (4, 4), 2: (N // 10, 4), 3: (N // 10, 4), 4: (4, 0), 5: (1, 0)}


def test_counts(spark, docs_of, rows):
    d = docs_of(rows=rows)
    assert {r.doc_id: r.size for r in sized(d).collect()} == {1: 40, 2: N, 3: N, 4: 40, 5: 0}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.n_words, r.base_failed) for r in Q.judge_quality(d, none).collect()}
    assert got == {1: (40, True), 2: (N, False), 3: (N, False), 4: (40, True), 5: (0, True)}
    out, n, ids, decoded = encode_documents(d, vocabulary_file())
    r = {x["doc_id"]: x for x in out.select("doc_id", n, F.length(ids).alias("b"), F.length(decoded).alias("c")).collect()}
    assert r[2][n] == r[3][n] > N and r[2]["b"] == 4 * r[2][n] and r[5][n] == 0


def test_many_secrets_in_one_text(docs_of):
    text = " ".join(f"token = {i:08d}" for i in range(20_000))
    spans = {r.doc_id: r.spans for r in S.scan(docs_of(rows=[(1, text, "en", "a"), (2, "none", "en", "a")])).collect()}
    assert len(spans[1]) == 20_000 and spans[2] == []
    assert all(s.start == 17 * i and s.end == 17 * i + 16 for i, s in enumerate(spans[1]))
