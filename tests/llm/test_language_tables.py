"""The language models hold every gram, whatever part of them is broadcast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadmill.llm import language_id as L

from .language_reference import Models

SF = "/root/testdata/sf0.001"


def in_memory(rows):
    """Models of (text, lang) rows by the in-process class, from all their grams."""
    langs = sorted({r.lang for r in rows})
    counts = []
    for x in langs:
        codes, owner, _ = L._codes([r.text for r in rows if r.lang == x])
        at, _ = L._grams(codes, owner)
        packed = np.zeros(len(at), np.uint64)
        for k in range(L.ORDER - 1, -1, -1):
            packed = (packed << np.uint64(16)) | codes[at - k]
        counts.append(np.unique(packed, return_counts=True))
    return Models(langs, counts)


@pytest.mark.parametrize("cache_bytes", [0, 8_000, 32 << 20])
@pytest.mark.parametrize("pack_bytes", [2_000, 8 << 20])
def test_every_gram_counts(spark, monkeypatch, cache_bytes, pack_bytes):
    """Equal cross-entropies with none, few and all grams broadcast, in one bucket of
    hash arrays and in many, unseen grams included."""
    if cache_bytes and pack_bytes == 2_000:
        pytest.skip("many buckets are met without a cache")
    monkeypatch.setattr(L, "CACHE_BYTES", cache_bytes)
    monkeypatch.setattr(L, "PACK_BYTES", pack_bytes)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null and lang is not null")
    learning = docs.where("doc_id % 2 = 0")
    tables = L.build(learning)
    cache = tables.frequent()
    assert cache.logp.nbytes + cache.grams.nbytes <= cache_bytes
    assert (len(cache.grams) > 0) == (cache_bytes > 0)
    want = in_memory(learning.collect())
    odd = spark.createDataFrame([(-1, "ぁ zqxj ωω 文"), (-2, "12 !"), (-3, None)], "doc_id long, text string")
    frame = docs.select("doc_id", "text").limit(60).unionByName(odd)
    rows = tables.entropies(frame, spark.sparkContext.broadcast(cache), ["doc_id"]).collect()
    text = {r.doc_id: r.text for r in frame.collect()}
    assert len(rows) == len(text)
    e, has = want.entropies([text[r.doc_id] for r in rows])
    assert tables.langs == want.langs and [r.has for r in rows] == has.tolist()
    assert np.allclose([r.e for r in rows], e, atol=1e-4)


def test_wide_characters_and_rare_grams_are_in_the_model(spark):
    """Grams past U+FFFF and grams that stand once are kept, in every order."""
    many = "".join(chr(0x4E00 + (i * 7919) % 20000) for i in range(130_000))
    rows = spark.createDataFrame([("\U00020000\U00020001 " + many, "x"), ("abc", "y")], "text string, lang string")
    tables = L.build(rows)
    got = {r.o: r["count"] for r in tables.grams.groupBy("o").count().collect()}
    codes, owner, _ = L._codes([r.text for r in rows.collect()])
    at, _ = L._grams(codes, owner)
    whole = {"".join(chr(int(codes[j - k])) for k in range(L.ORDER - 1, -1, -1)) for j in at}
    assert {o: len({g[-o:] for g in whole}) for o in range(1, L.ORDER + 1)} == got
    assert tables.grams.where(F.col("gram").contains("\U00020001")).select("o").distinct().count() == L.ORDER


def test_all_but_the_calibration_rows_are_counted(spark, monkeypatch):
    """A larger table holds out no more, and a language never all of its rows."""
    monkeypatch.setattr(L, "CALIBRATION", 50)
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(16))
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.lit("x").alias("lang"))
    first = rows.where(part == 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(3).select("doc_id")
    rare = first.select("doc_id", F.lit("\u03b1\u03b2\u03b3 \u03b4\u03b5").alias("text"), F.lit("rare").alias("lang"))
    rows = rows.join(first, "doc_id", "left_anti").unionByName(rare)
    held = {(r.lang, r.held): r["count"] for r in L.split(rows).groupBy("lang", "held").count().collect()}
    assert held == {("x", True): 47, ("x", False): 20_000 - 50, ("rare", False): 3}
    docs = spark.createDataFrame([(1, "\u03b2\u03b3 \u03b4\u03b5"), (2, "some text")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in L.identify(docs, rows.limit(2_000).unionByName(rare)).collect()} == {1: "rare", 2: "x"}
