"""Scalar functions against Python's own semantics (FIXTURES §3)."""

import hypothesis.strategies as st
from hypothesis import given, settings
from pyspark.sql import functions as F

from threadmill import config as C
from threadmill.functions import text as tx


def _one(spark, col_expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(col_expr(F.col("v")).alias("r")).first()["r"]


def py_clean(s):
    if not s:
        return ""
    return s.replace("\x00", "").replace("\r\n", "\n").strip()


def py_chunks(txt, size, overlap):
    if not txt:
        return []
    step = max(1, size - overlap)
    return [txt[i:i + size] for i in range(0, len(txt), step) if txt[i:i + size]]


def test_strip_set_is_python_whitespace():
    assert sorted(C.STRIP_CODEPOINTS) == [c for c in range(0x110000) if chr(c).isspace()]


def test_clean_text_cases(spark):
    assert _one(spark, tx.clean_text, None) == ""
    assert _one(spark, tx.clean_text, " a\r\nb\u0000 　") == "a\nb"
    assert _one(spark, tx.clean_text, "a\rb") == "a\rb"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \t\r\n\x00　 abé\U0001F600")), max_size=30), min_size=1, max_size=5))
def test_clean_text_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r["r"] for r in df.select(tx.clean_text("v").alias("r")).collect()]
    assert got == [py_clean(v) for v in values]


def test_chunk_lengths(spark):
    spec = C.ChunkSpec()
    for n, expect in [(0, []), (2080, [2080]), (2081, [2081, 1]), (5000, [2400, 2400, 840])]:
        got = _one(spark, lambda c: tx.chunk_array(c, spec.size, spec.step), "x" * n)
        assert [len(x) for x in got] == expect
    emoji = "\U0001F600" * 2500
    got = _one(spark, lambda c: tx.chunk_array(c, spec.size, spec.step), emoji)
    assert [len(x) for x in got] == [2400, 420]
    assert got == py_chunks(emoji, 2400, 320)


def test_chunk_overlap_ge_size_steps_by_one(spark):
    spec = C.ChunkSpec(size_tokens=2, overlap_tokens=5)
    assert spec.step == 1
    got = _one(spark, lambda c: tx.chunk_array(c, spec.size, spec.step), "abcdefghij")
    assert got == py_chunks("abcdefghij", 8, 20)


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \né\U0001F600")), max_size=60), st.integers(1, 12), st.integers(0, 14))
def test_chunks_reassemble(spark, text, size, overlap):
    step = max(1, size - overlap)
    got = _one(spark, lambda c: tx.chunk_array(c, size, step), text)
    assert got == py_chunks(text, size, overlap)


def test_validators(spark):
    df = spark.createDataFrame([("ab",), ("abc",), ("a" * 21,), ("a" * 22,), ("a-b",), ("abc\n",)], "v string")
    assert [r[0] for r in df.select(tx.valid_subreddit("v")).collect()] == [False, True, True, False, False, False]
    df = spark.createDataFrame([("abc",), ("ABC",), ("a" * 11,), ("a1b2",)], "v string")
    assert [r[0] for r in df.select(tx.valid_post_id("v")).collect()] == [True, False, False, True]


def test_permalink_and_urls(spark):
    assert _one(spark, tx.permalink, None) == C.PERMALINK_BASE
    assert _one(spark, tx.permalink, "/r/x/") == C.PERMALINK_BASE + "/r/x/"
    df = spark.createDataFrame([("s", "new", None), ("s", "top", "t3_x")], "sub string, sort string, after string")
    urls = [r[0] for r in df.select(tx.listing_url("sub", "sort", F.col("after"))).collect()]
    assert urls == [C.SITE_BASE + "/r/s/new.json?limit=100", C.SITE_BASE + "/r/s/top.json?after=t3_x&limit=100"]


def test_tokens_and_split_trim(spark):
    assert _one(spark, tx.tokens, "Héllo, Wörld! 12ab") == ["héllo", "wörld", "12ab"]
    assert _one(spark, tx.split_trim, " a, b ,c,") == ["a", "b", "c", ""]
