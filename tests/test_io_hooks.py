"""Sources/sinks and the pluggable model hooks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from threadmill import schemas
from threadmill.operators import prompts as PR
from threadmill.operators import rerank as RR
from threadmill.operators import vectors as VE
from threadmill.session import scratch_path
from threadmill.sources import files as io


def test_jsonl_permissive_quarantine(spark, tmp_path):
    path = scratch_path(spark, "t_jsonl")
    import os
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "part.json"), "w") as f:
        f.write('{"id": "a1", "title": "x", "score": 5}\n{broken\n{"id": "a2", "title": "é", "score": 7}\n')
    df = io.read_posts(spark, path, schemas.POSTS, fmt="JSONL", quarantine_col="_corrupt")
    rows = df.select("id", "_corrupt").collect()
    assert sorted(r["id"] for r in rows if r["id"]) == ["a1", "a2"]
    assert [r["_corrupt"] for r in rows if r["_corrupt"]] == ["{broken"]


def test_writer_skips_empty_and_splits_files(spark):
    path = scratch_path(spark, "t_write")
    empty = spark.createDataFrame([], "id string, ingest_date string")
    io.write_posts(empty, path)
    import os
    assert not os.path.exists(path.replace("file:", ""))
    df = spark.range(0, 250).select(F.col("id").cast("string").alias("id"), F.lit("2024-01-01").alias("ingest_date")).coalesce(1)
    io.write_posts(df, path, max_records_per_file=100)
    inv = io.file_inventory(spark, path).collect()
    assert len(inv) == 3 and [r["name"] for r in inv] == sorted(r["name"] for r in inv)
    assert io.read_posts(spark, path, df.schema).count() == 250


def test_upsert_by_id(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "chunk_id string, version int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "chunk_id string, version int")
    got = sorted((r[0], r[1]) for r in io.upsert_by_id(old, new).collect())
    assert got == [("a", 1), ("b", 2), ("c", 2)]


def test_model_hooks(spark):
    df = spark.createDataFrame([("aa",), ("b",)], "t string")
    emb = VE.embed_with(df, "t", lambda: lambda texts: np.array([[len(x), 1.0] for x in texts]), dims=2).collect()
    assert np.allclose(emb[0]["embedding"], np.array([2, 1]) / np.sqrt(5))
    pairs = spark.createDataFrame([("q", "abc"), ("q", "a")], "q string, t string")
    scorer = RR.pair_scorer_udf(lambda: lambda qs, ts: [float(len(t)) for t in ts])
    assert [r[0] for r in pairs.select(scorer("q", "t")).collect()] == [3.0, 1.0]
    prompts = spark.createDataFrame([(1, "hi")], "query_id long, user_prompt string")
    out = PR.complete_with(prompts, lambda: lambda pdf: pd.DataFrame({"query_id": pdf["query_id"], "completion": pdf["user_prompt"] + "!"}))
    assert out.first()["completion"] == "hi!"


def test_models_are_built_once_a_worker(spark, tmp_path):
    """Many batches and tasks; the factory leaves a file a call. A model that cannot be pickled is fine."""
    import os
    import threading
    calls = str(tmp_path)

    def factory():
        lock = threading.Lock()  # cannot be pickled
        open(f"{calls}/{os.getpid()}-{len(os.listdir(calls))}", "w").close()

        def embed(texts):
            with lock:
                return np.array([[len(x), os.getpid()] for x in texts])

        return embed

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(2_000).select(F.col("id").cast("string").alias("t")).repartition(16)
        rows = VE.embed_with(df, "t", factory, dims=2)
        assert rows.count() == 2_000 and len(rows.collect()) == 2_000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    made = [f.split("-")[0] for f in os.listdir(calls)]
    assert 1 <= len(made) == len(set(made)) <= spark.sparkContext.defaultParallelism * 2


def test_summary_json(spark):
    import json
    import glob
    path = scratch_path(spark, "t_summary")
    df = spark.createDataFrame([(10, 7, None)], "total long, completed long, speedup_estimate double")
    io.write_summary_json(df, path)
    files = glob.glob(path.replace("file:", "") + "/part-*.json")
    assert len(files) == 1
    assert json.loads(open(files[0]).read()) == {"total": 10, "completed": 7, "speedup_estimate": None}
