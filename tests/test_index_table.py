"""Documents replaced as a whole in a bucketed index; chunking in linear time."""

import os
import time

import pytest
from pyspark.sql import functions as F

from threadmill.functions import text as tx
from threadmill.operators import index_table as IX
from threadmill.session import scratch_path


def put(spark, path, batch, docs, buckets=4):
    """docs: {doc_id: (version, [texts])}"""
    rows = spark.createDataFrame([(d, i, t) for d, (_, ts) in docs.items() for i, t in enumerate(ts)], "doc_id string, ix int, t string")
    heads = spark.createDataFrame([(d, v) for d, (v, _) in docs.items()], "doc_id string, version long")
    IX.replace_documents(path, rows, heads, batch, buckets)


def held(spark, path):
    out = {}
    for r in IX.read_documents(spark, path).collect():
        out.setdefault(r.doc_id, []).append((r.ix, r.t))
    return {d: [t for _, t in sorted(x)] for d, x in out.items()}


def files(path):
    local = path.replace("file:", "")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(local) for f in fs if f.endswith(".parquet")}


def test_edited_shortened_unchanged_emptied_and_late(spark):
    path = scratch_path(spark, "t_index")
    put(spark, path, 0, {"long": (1, ["a", "b", "c"]), "same": (1, ["s"]), "gone": (1, ["g", "h"]), "new": (5, ["n5"])})
    put(spark, path, 1, {"long": (2, ["A"]), "gone": (2, []), "new": (4, ["n4", "late"])})
    now = {"long": ["A"], "same": ["s"], "new": ["n5"]}
    assert held(spark, path) == now
    put(spark, path, 1, {"long": (2, ["A"]), "gone": (2, []), "new": (4, ["n4", "late"])})  # replayed
    assert held(spark, path) == now
    assert IX.compact(spark, path, 2, buckets=4) > 0 and held(spark, path) == now
    assert IX.compact(spark, path, 2, buckets=4) == 0
    put(spark, path, 2, {"gone": (1, ["too late"]), "same": (1, ["landed again"])})  # older than the marker; equal version
    now["same"] = ["landed again"]
    assert held(spark, path) == now
    put(spark, path, 3, {"gone": (3, ["back"])})
    assert held(spark, path) == now | {"gone": ["back"]}


def test_untouched_buckets_keep_their_files(spark):
    path = scratch_path(spark, "t_buckets")
    put(spark, path, 0, {f"d{i}": (1, ["x"]) for i in range(40)}, buckets=8)
    before = files(path)
    put(spark, path, 1, {"d3": (2, ["y"])}, buckets=8)
    one = files(path).keys() - before.keys()
    assert len(one) == 1 and {k: v for k, v in files(path).items() if k in before} == before
    assert IX.compact(spark, path, 2, buckets=8) == 1
    bucket = next(iter(one)).split("/batch=")[0]
    kept = {k: v for k, v in before.items() if not k.startswith(bucket + "/")}
    assert kept and {k: v for k, v in files(path).items() if k in kept} == kept
    assert held(spark, path) == {f"d{i}": ["y" if i == 3 else "x"] for i in range(40)}
    with pytest.raises(ValueError):
        IX.compact(spark, path, 1, buckets=5)


def test_newest_row_of_a_key_is_not_left_to_chance(spark):
    rows = [("k", 1, "z"), ("k", 2, "a"), ("k", 2, "b"), ("m", None, "only")]
    df = spark.createDataFrame(rows, "id string, v int, t string").repartition(3)
    assert {r.id: r.t for r in IX.newest(df, "id", F.col("v")).collect()} == {"k": "b", "m": "only"}


def test_chunk_windows_of_odd_texts(spark):
    text = "aé😀\r\nx \u0085y \n" * 3
    for size, step in ((5, 3), (3, 5), (4, 4), (500, 450)):
        df = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(tx.chunk_array("t", size, step).alias("c"))
        assert [r.c for r in df.collect()] == [[text[i:i + size] for i in range(0, len(text), step)], [], []]


def test_chunking_is_linear_in_the_length(spark):
    def seconds(mb):
        df = spark.range(1).select(F.repeat(F.lit("abcdefgé"), mb * 131072).alias("t")).select(F.size(tx.chunk_array("t", 2000, 1800)))
        best = 1e9
        for _ in range(3):
            start = time.time()
            df.collect()
            best = min(best, time.time() - start)
        return best

    seconds(4)
    assert seconds(32) <= 2.2 * seconds(16) + 0.2


def test_tiered_compaction_rewrites_in_proportion(spark):
    """512 even batches, compacted after every third: each row is rewritten a few times only."""
    rewritten, held_now = 0, []
    for batch in range(512):
        held_now.append((2 * batch, 1))
        if batch % 3 == 2 and len(held_now) >= 3:
            run = IX._newest_run(held_now)
            n = sum(n for b, n in held_now if b in run)
            rewritten += n * (len(run) > 1)
            held_now = [(b, m) for b, m in held_now if b not in run] + [(run[-1] | 1, n)]
            sizes = [m for _, m in sorted(held_now)]
            assert all(m > sum(sizes[i + 1:]) for i, m in enumerate(sizes))
    assert rewritten <= 512 * 10 and len(held_now) <= 12

    path, now = scratch_path(spark, "t_tiers"), {}
    for batch in range(6):
        docs = {f"d{i}": (batch % 3, [f"{batch}-{i}"]) for i in range(batch, batch + 6)} | {"gone": (1, [] if batch else ["g"])}
        put(spark, path, batch, docs, buckets=2)
        IX.compact(spark, path, 2, buckets=2, tiered=True)
        now.update({d: x for d, x in docs.items() if d not in now or x[0] >= now[d][0]})
        assert held(spark, path) == {d: ts for d, (_, ts) in now.items() if ts}
