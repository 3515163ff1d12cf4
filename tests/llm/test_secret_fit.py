"""Secrets that the base patterns miss don't teach the scan that they are ordinary."""

import random

import pytest
from pyspark.sql import functions as F

from threadmill.llm import secret_scan as S

SF = "/root/testdata/sf0.01"
KEY = "abcdefghijklmnopqrstuvwxyz0123456789"


def uuid(rng):
    return "-".join("".join(rng.choice("0123456789ABCDEF") for _ in range(n)) for n in (8, 4, 4, 4, 12))


def key(rng):
    return "".join(rng.choice(KEY) for _ in range(32))


@pytest.mark.parametrize("share", [5, 20])
@pytest.mark.parametrize("make", [key, uuid])
def test_many_unmatched_secrets(spark, share, make):
    rng = random.Random(share)
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("text is not null").collect()
    rows = [(r.doc_id, r.text + (f" see {make(rng)} here" if rng.randrange(100) < share else "")) for r in rows]
    table, threshold = S.fit_ratios(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    unseen = spark.createDataFrame([(make(rng),) for _ in range(300)], "s string")
    found = unseen.where(S.ratio(F.col("s"), table) > threshold).count()
    usual = spark.createDataFrame([("internationalization_of_words",), ("understanding-the-configuration",)], "s string")
    print("found", make.__name__, share, found / 300, threshold)
    assert found >= 0.9 * 300
    assert usual.where(S.ratio(F.col("s"), table) > threshold).count() == 0


def test_every_document_and_value_teaches(spark):
    """The model follows the counts of the whole table, whatever its size: 9,000 documents,
    of which any 2,000 hold few of the identifiers that matter."""
    rng = random.Random(1)
    rows = [(i, f"value {'qzqzqzqz' if i % 3000 == 0 else 'ordinary'} {'ordinary_words_' * 20 if i == 1 else 'words'}") for i in range(9_000)]
    rows += [(9_000 + i, f"password = {key(rng)}") for i in range(60)]
    seen = []
    real = S._ratios
    S._ratios = lambda random, usual: seen.append((random, dict(usual))) or real(random, usual)
    try:
        S.fit_ratios(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    finally:
        S._ratios = real
    usual = seen[-1][1]
    assert usual[ord("q"), ord("z")] == 3 * 4 and usual[ord("o"), ord("r")] == 8_997 + 2 * 20
    assert usual[ord("_"), ord("w")] == 20
