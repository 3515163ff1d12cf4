"""The pipeline's stages on a small table, and the registered queries."""

import corpus_pipeline as P
from threadmill.llm.common import stored
from threadmill.llm.minhash_dedup import near_duplicates
from threadmill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_names():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} and len(QUERIES) == 13
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "tokens"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("n_chars", "kept")
    extra = docs.limit(2).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "kept")
    now = docs.unionByName(docs.limit(3)).unionByName(extra)
    for name, stage in P.STAGES:
        before = now
        now = stored(stage(spark, before, SF), name)
        if name != "tokens":
            assert now.columns == docs.columns
        if name == "quality_rules":
            assert 0 < now.count() < before.count()
        if name == "near_dedup":
            known = now.where("doc_id is not null")
            assert known.count() == known.select("doc_id").distinct().count()
            assert near_duplicates(known, words=4).where("not kept").count() == 0
            assert now.where("doc_id is null").count() == before.where("doc_id is null").count()
        if name == "mixing":
            assert now.groupBy("doc_id").count().where("count > 3 and doc_id is not null").count() == 0
    assert now.where("length(ids) <> 4 * n_tokens").count() == 0 and now.count() > 0


def test_empty_table(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in P.STAGES:
        now = stored(stage(spark, now, SF), name)
        assert now.count() == 0


def test_repeated_ids_leave_one_text_whatever_the_order(spark):
    """Of different texts under one doc_id the same one stays, however the rows are dealt."""
    words = [f"w{i}" for i in range(300)]
    rows = [(i % 5, " ".join(words[i : i + 40]), "en", "s", 1, 2) for i in range(0, 200, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, rows int, text_hash int")
    stays = [sorted(map(str, P.near_dedup(spark, d, SF).collect())) for d in (docs.coalesce(1), docs.repartition(7), docs.orderBy("text"))]
    assert stays[0] == stays[1] == stays[2] and len({r.split(",")[0] for r in stays[0]}) == len(stays[0])
