"""Near-duplicate clusters vs brute force; streaming == batch."""

import collections
import itertools
import random
import re

from pyspark.sql import functions as F

from threadmill.operators import dedupe as DD
from threadmill.operators import hot_keys
from threadmill.operators.components import connected_components
from threadmill.streaming import jobs as SJ
from threadmill.session import scratch_path


def test_exact_and_near_duplicates(spark):
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word30", "other30")
    texts = [(1, base), (2, base.upper()), (3, near), (4, "completely different text " * 5), (5, "  " + base + "\n")]
    df = spark.createDataFrame(texts, "id long, text string")
    groups = DD.exact_dup_groups(df, "id", "text").collect()
    assert [(g["n_docs"], g["first_id"]) for g in groups] == [(3, 1)]
    cl = {r["id"]: r["cluster_id"] for r in DD.near_dup_clusters(df, "id", "text").collect()}
    assert cl.get(1) == cl.get(2) == cl.get(3) == cl.get(5) == 1 and 4 not in cl


def union_find(nodes, pairs):
    parent = {i: i for i in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in pairs:
        ri, rj = find(i), find(j)
        parent[max(ri, rj)] = min(ri, rj)
    return {i: find(i) for i in nodes}


def test_components_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(999, i) for i in range(1000, 1400)] + [(3, 3)]
    got = {r["id"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {i for e in edges if e[0] != e[1] for i in e}
    assert got == union_find(nodes, [e for e in edges if e[0] != e[1]])


def test_chain_of_a_thousand(spark):
    """Logarithmic rounds, however the ids lie along the chain."""
    ids = list(range(1000))
    random.Random(2).shuffle(ids)
    for chain in (range(1000), ids):
        rounds = []
        edges = spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long")
        labels = connected_components(edges, rounds).select("label").distinct().collect()
        assert [r.label for r in labels] == [0] and len(rounds) <= 20


def brute_clusters(texts, shingle=5, percent=80):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if w:
            sets[i] = {tuple(w[j:j + shingle]) for j in range(max(len(w) - shingle + 1, 1))}
    pairs = [(i, j) for i, j in itertools.combinations(sorted(sets), 2)
             if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    label = union_find(sorted({x for p in pairs for x in p}), pairs)
    size = collections.Counter(label.values())
    return {i: (c, size[c]) for i, c in label.items()}


def near_copies(rng):
    """Random texts, chains of edits, exact copies of a third of all rows, and texts
    that share a bucket with texts they are not similar to."""
    word = lambda: f"w{rng.randrange(4000)}"
    texts = []
    for _ in range(25):
        t = [word() for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.randrange(1, 7)):
            texts.append(" ".join(t))
            t = list(t)
            for _ in range(rng.choice([0, 1, 2, 3])):
                t[rng.randrange(len(t))] = word()
    texts += ["one text that very many documents share , word for word"] * 60
    texts += [None, "", " .,! ", "x", "X!"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_duplicates_equal_brute_force(spark):
    for seed in (1, 2):
        texts = near_copies(random.Random(seed))
        df = spark.createDataFrame(texts + [(None, "x")], "id long, text string").repartition(4)
        got = {r.id: (r.cluster_id, r.cluster_size) for r in DD.near_dup_clusters(df, "id", "text").collect()}
        assert got == brute_clusters(texts)


def test_members_outside_their_pivots_component(spark, monkeypatch):
    """Few bands of one row: buckets hold texts that are not similar, so most links
    are found among the texts outside the component of the bucket's smallest id."""
    texts = near_copies(random.Random(3))
    monkeypatch.setattr(DD, "BANDS", 64)
    monkeypatch.setattr(DD, "ROWS", 1)
    got = {r.id: (r.cluster_id, r.cluster_size) for r in
           DD.near_dup_clusters(spark.createDataFrame(texts, "id long, text string"), "id", "text").collect()}
    assert got == brute_clusters(texts)


def test_empty_table_has_no_clusters(spark):
    df = spark.createDataFrame([], "id long, text string")
    clusters = DD.near_dup_clusters(df, "id", "text")
    assert clusters.count() == 0 and DD.largest_clusters(clusters).count() == 0


def test_hot_keys_stay_spread(spark, monkeypatch):
    """A key of a third of all rows gives no partition above twice the mean."""
    monkeypatch.setattr(hot_keys, "SHARE", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") + 1).alias("k")).repartition(8)
        counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        hot = hot_keys.hot_keys(counts, "k", 30_000)
        table = counts.select("k", F.col("n").alias("v"))
        out = hot_keys.lookup(rows, table, "k", hot)
        assert out.count() == 30_000 and out.where("k = 0 and v <> 10000").isEmpty()
        splits = hot_keys.splits_of(counts, "k", 30_000)
        left, right = hot_keys.salted(rows, "k", "id", splits), hot_keys.repeated(table, "k", splits)
        both = left.join(right, ["k", "_salt"])
        for joined in (out, both):
            sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.avg("count")).first()
            assert sizes[0] <= 2 * sizes[1] and joined.count() == 30_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_dedupe_equals_batch(spark):
    rows = [(f"p{i % 7}", i, f"2024-01-0{1 + i % 5} 00:00:00") for i in range(40)]
    df = spark.createDataFrame(rows, "id string, n long, ts string").withColumn("scraped_at", F.col("ts").cast("timestamp"))
    landing = scratch_path(spark, "t_land")
    df.withColumn("day", F.to_date("scraped_at")).write.partitionBy("day").parquet(landing)
    schema = spark.read.parquet(landing).schema
    out, ck = scratch_path(spark, "t_out"), scratch_path(spark, "t_ck")
    SJ.run(SJ.dedupe_stream(SJ.source(spark, landing, schema, max_files_per_trigger=1), delay="30 days"), out, ck)
    got = sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert got == sorted({r[0] for r in rows})


def test_stream_index_jsonl_quarantines_bad_lines(spark):
    import os
    from pyspark.sql import types as T
    landing = scratch_path(spark, "t_jl")
    local = landing.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "a.json"), "w") as f:
        f.write('{"id": "p1", "title": "T1", "selftext": "body one", "permalink": "/r/s/1", "subreddit": "s", "score": 4, "created_utc": 1.0}\n')
        f.write("{not json\n")
        f.write('{"id": "p2", "title": "T2", "selftext": "", "permalink": "/r/s/2", "subreddit": "s", "score": 5, "created_utc": 2.0}\n')
    schema = T.StructType([T.StructField(n, t) for n, t in [("id", T.StringType()), ("title", T.StringType()), ("selftext", T.StringType()),
                                                           ("permalink", T.StringType()), ("subreddit", T.StringType()),
                                                           ("score", T.LongType()), ("created_utc", T.DoubleType())]])
    out, ck, bad = scratch_path(spark, "t_jl_out"), scratch_path(spark, "t_jl_ck"), scratch_path(spark, "t_jl_bad")
    SJ.index_stream(spark, landing, schema, out, ck, fmt="json", quarantine_path=bad)
    rows = spark.read.parquet(out).collect()
    assert sorted(r["doc_id"] for r in rows) == ["p1", "p2"] and len(rows[0]["embedding"]) == 256
    assert [r["_corrupt_record"] for r in spark.read.parquet(bad).collect()] == ["{not json"]


def _ordered_landings(spark, name, landings, schema):
    path = scratch_path(spark, name)
    for rows in landings:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path, spark.createDataFrame([], schema).schema


def test_late_rows_are_kept_apart_and_state_expires(spark):
    import datetime as dt

    def at(day, hour=0):
        return dt.datetime(2024, 1, day, hour)

    landings = [[(1, at(1)), (2, at(2))], [(3, at(4)), (4, at(1, 5)), (5, None)], [(6, at(9)), (7, at(3)), (8, at(3, 1))]]
    landing, schema = _ordered_landings(spark, "t_late", landings, "id long, t timestamp")
    on, late, marks, ck = (scratch_path(spark, f"t_late_{x}") for x in ("on", "late", "marks", "ck"))
    SJ.split_late(spark, landing, schema, "t", "1 day", on, late, marks, ck)
    got = {p: sorted((r.batch_id, r.id) for r in spark.read.parquet(p).collect()) for p in (on, late)}
    # marks of earlier batches: none, day 2, day 4
    assert got[on] == [(0, 1), (0, 2), (1, 3), (1, 4), (2, 6), (2, 8)]
    assert got[late] == [(1, 5), (2, 7)]
    # a key a day, each twice: what is behind the watermark leaves the state
    days = [[(d, at(d)), (d, at(d, 1))] for d in range(1, 11)]
    landing, schema = _ordered_landings(spark, "t_days", days, "id long, t timestamp")
    out, ck = scratch_path(spark, "t_days_out"), scratch_path(spark, "t_days_ck")
    stream = SJ.dedupe_stream(SJ.source(spark, landing, schema, max_files_per_trigger=1), key="id", event_time="t", delay="1 day")
    q = SJ.run(stream, out, ck)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(1, 11))
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert max(held) <= 5 and sum(p["stateOperators"][0]["numRowsRemoved"] for p in q.recentProgress) >= 6


def test_stalled_jobs_by_timers(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)

    def row(i, url, status, minutes):
        return (i, url, status, t0 + dt.timedelta(minutes=minutes))

    landings = [
        [row(1, "a", "in_progress", 0), row(2, "b", "in_progress", 0), row(3, "c", "completed", 1), row(4, "d", "in_progress", 0)],
        [row(5, "a", "completed", 5), row(6, "d", "pending", 40)],  # a is finished in time; d is taken up again too late
        [row(7, "b", "in_progress", 60), row(8, "e", "in_progress", 300)],
        [row(9, "clock", "pending", 100_000)],
    ]
    landing, schema = _ordered_landings(spark, "t_stall", landings, "id long, url string, status string, created_at timestamp")
    out, ck = scratch_path(spark, "t_stall_out"), scratch_path(spark, "t_stall_ck")
    stream = SJ.source(spark, landing, schema, max_files_per_trigger=1)
    q = SJ.run_stateful(SJ.stalled_jobs(stream, stall="10 minutes", keep="1 hour", delay="1 minute"), out, ck)
    got = sorted((r.url, r.id, int((r.stalled_at - t0).total_seconds() // 60)) for r in spark.read.parquet(out).collect())
    assert got == [("b", 2, 10), ("b", 7, 70), ("d", 4, 10), ("e", 8, 310)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != SJ.ROCKSDB
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 3  # the clock's own rows


def test_only_texts_that_share_a_bucket_bring_their_sets(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(5)] + [(2000 + i, rows[i][1]) for i in range(5)]
    met = []
    real = DD.near_dup_links
    monkeypatch.setattr(DD, "near_dup_links", lambda reps, sets_of, percent: real(
        reps, lambda ids: met.append(sets_of(ids).count()) or sets_of(ids), percent))
    got = {r.id: (r.cluster_id, r.cluster_size) for r in DD.near_dup_clusters(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert got == {k + i: (i, 3) for i in range(5) for k in (0, 1000, 2000)}
    assert met == [10]
