"""Values out of range, repeated writes and layout guards."""

from pyspark.sql import functions as F

from threadmill.functions import text as tx
from threadmill.operators import posts as P
from threadmill.operators.layout import spread
from threadmill.session import scratch_path
from threadmill.sources import files as io


def test_coercion_never_raises(spark):
    df = spark.createDataFrame([("1e30",), ("inf",), ("nan",), ("-7.9",), ("9007199254740993",), ("x",), (None,)], "s string")
    got = [r.v for r in df.select(tx.coerce_long("s", 5).alias("v")).collect()]
    assert got == [5, 5, 5, -7, 9007199254740993, 5, 5]
    times = [r.t for r in df.select(tx.epoch_to_ts("s").alias("t")).collect()]
    assert times[:3] == [None] * 3 and times[3] is not None and times[5:] == [None] * 2


def test_report_is_ordered_by_name(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), (None,)], "subreddit string")
    assert [(r.subreddit, r.n_posts) for r in P.posts_per_subreddit(df).collect()] == [("a", 1), ("b", 2), ("unknown", 1)]


def test_second_day_keeps_the_first(spark):
    path = scratch_path(spark, "days")
    day = lambda d, n: spark.range(n).withColumn("ingest_date", F.lit(d))
    io.write_posts(day("2024-01-01", 3), path)
    io.write_posts(day("2024-01-02", 2), path)
    io.write_posts(day("2024-01-02", 4), path, mode="overwrite")
    got = {str(r.ingest_date): r["count"] for r in spark.read.parquet(path).groupBy("ingest_date").count().collect()}
    assert got == {"2024-01-01": 3, "2024-01-02": 4}


def test_upsert_keeps_one_row_a_key(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "chunk_id string, v int")
    new = spark.createDataFrame([("a", 2), ("a", 3), ("c", 1)], "chunk_id string, v int")
    for version in (None, "v"):
        got = sorted((r.chunk_id, r.v) for r in io.upsert_by_id(old, new, version=version).collect())
        assert got == [("a", 3), ("b", 1), ("c", 1)]


def test_spread_looks_at_files_only(spark):
    path = scratch_path(spark, "one_file")
    spark.range(100).coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    assert spread(spark.range(10), 64).count() == 10
    assert spread(one, 1) is one


def test_a_set_number_of_partitions_is_left_alone(spark):
    from threadmill.session import configure

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        configure(spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scratch_folders_can_be_cleared(spark, monkeypatch):
    import os
    from threadmill import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    paths = [session.scratch_path(spark, "t_clear") for _ in range(3)]
    for p in paths[:2]:
        spark.range(3).write.parquet(p)
    assert session.clear_scratch(spark) == 2 and session.clear_scratch(spark) == 0
    assert not any(os.path.exists(p.replace("file:", "")) for p in paths)


def test_lent_settings_come_back(spark):
    from threadmill.session import configure, lend_setting

    key, own = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.files.maxPartitionBytes"
    spark.conf.set(own, "64m")
    before = spark.conf.get(key)
    for _ in range(2):  # lent twice, the first value counts
        lend_setting(spark, key, "7")
        lend_setting(spark, own, "1m")
    assert spark.conf.get(key) == "7"
    configure(spark)
    assert spark.conf.get(key) == before and spark.conf.get(own) == "64m"
    spark.conf.unset(own)
