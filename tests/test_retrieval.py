"""Vectors, top-k, BM25, snippets and prompts against brute force."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from threadmill import config as C
from threadmill.operators import posts as P
from threadmill.operators import prompts as PR
from threadmill.operators import rerank as RR
from threadmill.operators import vectors as VE

from conftest import SF


def test_topk_matches_numpy(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(300, 16))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    q = rng.normal(size=(7, 16))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    vec = spark.createDataFrame([(i, m[i].tolist(), i % 5) for i in range(300)], "vec_id long, embedding array<double>, score long").repartition(6)
    qs = spark.createDataFrame([(j, q[j].tolist()) for j in range(7)], "query_id long, qvec array<double>")
    got = VE.topk_exact(vec, qs, 10).collect()
    for j in range(7):
        s = np.round(m @ q[j], 6)
        want = sorted(range(300), key=lambda i: (-s[i], i))[:10]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == j), key=lambda r: r["rank"])] == want
    # filter before scoring (payload filter), blocks of queries give the same answer
    f = VE.topk_exact(vec, qs, 10, where=P.payload_filter({"min_score": 3}), max_side_bytes=200).collect()
    assert all(r["vec_id"] % 5 >= 3 for r in f) and len(f) == 70


def test_hashed_embedding_unit_norm(spark):
    df = spark.createDataFrame([("Hello hello world",), ("",)], "t string")
    rows = VE.embed_hashed(df, "t").collect()
    assert abs(sum(x * x for x in rows[0]["embedding"]) - 1) < 1e-12
    assert sum(rows[1]["embedding"]) == 0 and len(rows[1]["embedding"]) == C.HASH_DIMS


def py_bm25(docs, query, k1=C.BM25_K1, b=C.BM25_B):
    tok = lambda s: [t for t in re.split(r"[^\w]+|_", s.lower()) if t]
    toks = {d: tok(t) for d, t in docs.items()}
    n, avgdl = len(docs), sum(len(v) for v in toks.values()) / len(docs)
    q = set(tok(query))
    out = {}
    for d, ts in toks.items():
        s = 0.0
        for t in q:
            tf = ts.count(t)
            if tf:
                df = sum(1 for v in toks.values() if t in v)
                s += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ts) / avgdl))
        if s:
            out[d] = round(s, 6)
    return out


def test_bm25_matches_brute_force(spark):
    docs = {1: "the cat sat on the mat", 2: "the dog sat", 3: "cats and dogs", 4: "a mat for the cat cat"}
    corpus = spark.createDataFrame(list(docs.items()), "id long, text string")
    qs = spark.createDataFrame([(10, "cat mat"), (11, "dog")], "query_id long, query_text string")
    got = {(r["query_id"], r["id"]): r["score"] for r in RR.bm25_topk(corpus, qs, "id", "text", k=10).collect()}
    for qid, qt in [(10, "cat mat"), (11, "dog")]:
        for d, s in py_bm25(docs, qt).items():
            assert abs(got[(qid, d)] - s) < 1e-6
    pairs = spark.createDataFrame([(10, 1), (10, 3)], "query_id long, id long")
    pr = {r["id"]: r["rerank_score"] for r in RR.bm25_pairs(pairs, corpus, qs, "id", "text").collect()}
    assert pr[3] == 0.0 and abs(pr[1] - py_bm25(docs, "cat mat")[1]) < 1e-6


def test_rerank_ties_keep_vector_rank(spark):
    df = spark.createDataFrame([(1, "a", 1, 0.5), (1, "b", 2, 0.5), (1, "c", 3, 0.9)], "query_id long, id string, rank int, rerank_score double")
    assert [r["id"] for r in RR.rerank_topn(df, 2).orderBy("rerank_rank").collect()] == ["c", "a"]


def test_snippets_and_prompts(spark):
    ranked = spark.createDataFrame([(1, 2, "x\ny", "L2"), (1, 1, "first", "L1")], "query_id long, rerank_rank int, chunk_text string, permalink string")
    b = PR.snippet_block(ranked).first()
    assert b["snippets"] == "- first (link: L1)\n- x y (link: L2)"
    blocks = spark.createDataFrame([(1, "- has {snippets} and {n} and 100% (link: L)")], "query_id long, snippets string")
    user = PR.prompt_ideas(blocks, 5).first()["user_prompt"]
    assert user == C.IDEA_GEN_USER.format(n=5, snippets="- has {snippets} and {n} and 100% (link: L)")
    pains = PR.prompt_pains(blocks.withColumn("q", F.lit("{subs}")), F.col("q"), F.lit("a,b"), F.lit(C.DEFAULT_PERIOD)).first()
    assert pains["user_prompt"] == C.PAIN_MINING_USER.format(topic="{subs}", subs="a,b", period=C.DEFAULT_PERIOD, snippets=blocks.first()["snippets"])
    assert [m["role"] for m in pains["messages"]] == ["system", "user"]


def _recall(spark, vec, qs, **kw):
    from threadmill.operators import cells as CE

    read = []
    exact = {(r["query_id"], r["vec_id"]) for r in VE.topk_exact(vec.where("embedding is not null"), qs, 10).collect()}
    found = {(r["query_id"], r["vec_id"]) for r in CE.topk_cells(CE.build_cells(vec), qs, 10, read=read, **kw).collect()}
    assert len(found) == len(exact)
    return len(found & exact) / len(exact), sum(read) / len(read)


def test_cells_reach_their_recall_on_driver_vectors(spark):
    """Vectors without clusters: the recall holds, at the price of many cells."""
    from threadmill.plans import views as V

    vec = V.vectors_v(spark, "/root/testdata/sf0.1")
    qs = VE.centroids(vec, "label").select(F.col("label").cast("long").alias("query_id"), "qvec")
    recall, read = _recall(spark, vec, qs)
    assert recall >= 0.9 and read < 0.8
    assert _recall(spark, vec, qs, missed=0.0) == (1.0, 1.0)
    # a block of queries at a time
    assert _recall(spark, vec, qs, max_side_bytes=20_000)[0] >= 0.9


def test_clustered_vectors_are_searched_in_few_cells(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    centre = rng.normal(size=(40, 16))
    x = (centre[rng.integers(0, 40, 6000)] + 0.15 * rng.normal(size=(6000, 16))).round(4)
    vec = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9999, None)], "vec_id long, embedding array<double>")
    qs = spark.createDataFrame([(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(x[:20])], "query_id long, qvec array<double>")
    recall, read = _recall(spark, vec, qs)
    assert recall >= 0.9 and read <= 0.2


def test_cells_of_few_and_equal_vectors(spark):
    from threadmill.operators import cells as CE

    qs = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, qvec array<double>")
    for rows in ([], [(1, [0.5, 0.5])], [(i, [1.0, 2.0]) for i in range(30)], [(1, [0.0, 0.0]), (2, [3.0, 1.0])]):
        vec = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = [(r.vec_id, r.score) for r in CE.topk_cells(CE.build_cells(vec), qs, 3).orderBy("rank").collect()]
        assert got == sorted(((i, v[0]) for i, v in rows), key=lambda t: (-t[1], t[0]))[:3]


def test_bm25_topk_matches_brute_force(spark):
    docs = {i: t for i, t in enumerate(["the cat sat on the mat", "the dog sat", "cats and dogs", "a mat for the cat cat",
                                        "dog dog dog", "nothing here", "mat mat cat dog the"])}
    corpus = spark.createDataFrame(list(docs.items()), "id long, text string").repartition(3)
    qs = spark.createDataFrame([(10, "cat mat"), (11, "dog"), (12, "zebra")], "query_id long, query_text string")
    got = RR.bm25_topk(corpus, qs, "id", "text", k=3).collect()
    for qid, qt in [(10, "cat mat"), (11, "dog"), (12, "zebra")]:
        want = sorted(py_bm25(docs, qt).items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        rows = sorted((r for r in got if r["query_id"] == qid), key=lambda r: r["rank"])
        assert [(r["id"], r["score"]) for r in rows] == [(d, s) for d, s in want]


def test_bm25_index_skips_blocks_and_serves_many_batches(spark, monkeypatch):
    """Small segments: most are skipped, the answers are those of a full scan, and
    the corpus is tokenised once for all batches of queries."""
    import random
    from threadmill.operators import bm25_index as BX

    monkeypatch.setattr(BX, "SEGMENT", 16)
    monkeypatch.setattr(BX, "FIRST", 2)
    rng = random.Random(6)
    docs = {i: " ".join(rng.choice(["the", "of", "and", f"w{rng.randrange(400)}"]) for _ in range(rng.randrange(1, 40))) for i in range(1200)}
    for i in range(0, 1200, 150):
        docs[i] = "needle thread the of"
    corpus = spark.createDataFrame(list(docs.items()) + [(5000, None), (5001, "")], "id long, text string").repartition(3)
    index = BX.build_index(corpus, "id", "text")
    assert index.n == 1202
    for batch in ([(1, "needle the"), (2, "w7 w8 the of")], [(3, "the and"), (4, "absent"), (5, None)]):
        qs = spark.createDataFrame(batch, "query_id long, query_text string")
        skipped = []
        got = {}
        for r in BX.top_documents(index, qs, "id", 5, skipped=skipped).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
        for q, text in batch:
            want = sorted(py_bm25({**docs, 5000: "", 5001: ""}, text or "").items(), key=lambda kv: (-kv[1], kv[0]))[:5]
            assert [(d, s) for _, d, s in sorted(got.get(q, []))] == [(d, s) for d, s in want if s > 0]
        if batch[0][0] == 1:
            assert skipped[0][1] < skipped[0][0] / 2


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_bm25_index_is_built_without_a_shuffle(spark, tmp_path):
    """What a task has tokenised it also inverts; neither hits nor documents are dealt anew."""
    import random
    from threadmill.operators import bm25_index as BX

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "of", f"w{rng.randrange(900)}"]) for _ in range(60))) for i in range(600)]
    spark.createDataFrame(rows, "id long, text string").repartition(4).write.parquet(str(tmp_path / "docs"))
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "1k")  # splits enough for all cores
    try:
        before = _shuffle_files(spark)
        index = BX.build_index(spark.read.parquet(str(tmp_path / "docs")), "id", "text")
        assert not _shuffle_files(spark) - before
    finally:
        spark.conf.set(key, old)
    qs = spark.createDataFrame([(1, "w1 w2 the")], "query_id long, query_text string")
    got = [(r.id, r.score) for r in BX.top_documents(index, qs, "id", 5).orderBy("rank").collect()]
    assert got == sorted(py_bm25(dict(rows), "w1 w2 the").items(), key=lambda kv: (-kv[1], kv[0]))[:5]


def test_bm25_ties_and_odd_keys(spark, monkeypatch):
    """Equal scores in many small segments: the smallest ids win, null before all; a
    repeated id is a document each time, a repeated query counts its terms again."""
    from threadmill.operators import bm25_index as BX

    monkeypatch.setattr(BX, "SEGMENT", 8)
    monkeypatch.setattr(BX, "HITS", 10)
    monkeypatch.setattr(BX, "ASKED", 2, raising=False)
    monkeypatch.setattr(BX, "BROADCAST", 0, raising=False)
    ids = [f"d{i:03d}" for i in range(90)]
    rows = [(i, "cat mat") for i in ids[::-1]] + [("d050", "cat mat"), (None, "cat mat"), ("z", "dog"), ("y", None), ("x", "")]
    corpus = spark.createDataFrame(rows, "id string, text string").repartition(3)
    qs = spark.createDataFrame([(1, "cat"), (2, "dog"), (2, "dog"), (None, "cat")], "query_id long, query_text string")
    index = BX.build_index(corpus, "id", "text")
    got = {}
    for r in BX.top_documents(index, qs, "id", 4).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    one = {i: t or "" for i, (_, t) in enumerate(rows)}
    assert [i for i, _ in got[1]] == [None, "d000", "d001", "d002"] and {s for _, s in got[1]} == {py_bm25(one, "cat")[0]}
    assert [i for i, _ in got[2]] == ["z"] and abs(got[2][0][1] - 2 * py_bm25(one, "dog")[92]) < 2e-6
    assert set(got) == {1, 2}
    pairs = spark.createDataFrame([(1, "d050"), (1, "z")], "query_id long, id string")
    scores = {r.id: r.rerank_score for r in BX.pair_scores(index, pairs, qs, "id").collect()}
    assert scores["z"] == 0.0 and abs(scores["d050"] - 2 * py_bm25(one, "cat")[0]) < 2e-6
    nested = BX.build_index(corpus.selectExpr("struct(id) AS id", "text"), "id", "text")
    best = BX.top_documents(nested, qs.where("query_id = 1"), "id", 3).orderBy("rank").collect()
    assert [r.id.id for r in best] == [None, "d000", "d001"]


def test_bm25_of_an_empty_corpus(spark):
    corpus = spark.createDataFrame([], "id long, text string")
    qs = spark.createDataFrame([(1, "a")], "query_id long, query_text string")
    assert RR.bm25_topk(corpus, qs, "id", "text").count() == 0
    pairs = spark.createDataFrame([(1, 2)], "query_id long, id long")
    assert [r.rerank_score for r in RR.bm25_pairs(pairs, corpus, qs, "id", "text").collect()] == [0.0]


def test_bm25_pairs_cover_all_candidates(spark):
    docs = {i: t for i, t in enumerate(["the cat sat on the mat", "the dog sat", "cats and dogs", "a mat for the cat cat",
                                        "dog dog dog", "nothing here"])}
    corpus = spark.createDataFrame(list(docs.items()), "id long, text string").repartition(2)
    qs = spark.createDataFrame([(10, "cat mat"), (11, "dog"), (12, "")], "query_id long, query_text string")
    pairs = spark.createDataFrame([(10, 0), (10, 2), (10, 5), (11, 1), (11, 4), (12, 3)], "query_id long, id long")
    got = {(r["query_id"], r["id"]): r["rerank_score"] for r in RR.bm25_pairs(pairs, corpus, qs, "id", "text").collect()}
    assert len(got) == 6
    for (q, d), v in got.items():
        assert abs(v - py_bm25(docs, {10: "cat mat", 11: "dog", 12: ""}[q]).get(d, 0.0)) < 1e-6


def test_ties_stay_bounded(spark):
    import numpy as np
    from threadmill.operators.topk import bounded_topk

    vec = spark.range(20_000).selectExpr("id as vec_id", "array(if(id < 3, 1.0D, 0.0D), 1.0D) as embedding").coalesce(1)
    qs = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, qvec array<double>")
    out = VE.topk_exact(vec, qs, 10).collect()
    assert sorted(r["vec_id"] for r in out) == list(range(10))
    scores = np.zeros(50_000)
    scores[:3] = 1
    ids = np.arange(50_000)[::-1]
    keep = bounded_topk(scores, ids, 10, 6)
    assert len(keep) <= 200 and set(range(9)) <= set(ids[keep].tolist())
    rng = np.random.default_rng(0)
    s = rng.choice([0.5, 0.5000004, 0.5000006, 0.4999996, 0.7, 0.1], 4000) + rng.choice([0, 1e-12], 4000)
    want = np.lexsort((ids[:4000], -np.round(s, 6)))[:25]
    assert set(want) <= set(bounded_topk(s, ids[:4000], 25, 6))


def test_topk_makes_few_rows_dense_at_once(spark, monkeypatch):
    """Slices are bounded by rows and by list entries, and hold every row in order."""
    import pyarrow as pa

    lists = [list(range(n % 7)) for n in range(3000)] + [list(range(500_000))] + [None, []]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(lists))), pa.array(lists, pa.list_(pa.int32()))], ["id", "v"])
    parts = list(VE._slices(batch, "v"))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(len(lists)))
    for p in parts:
        entries = sum(len(x or []) for x in p.column("v").to_pylist())
        assert p.num_rows <= VE.SLICE_ROWS and (entries <= VE.SLICE_ENTRIES or p.num_rows == 1)
