"""The file reports look at what was written."""

from pyspark.sql import functions as F

from threadmill.operators import frontier as FR
from threadmill.plans import q_frontier, q_retrieval
from threadmill.sources import files as io
from threadmill.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_inventory_counts_what_lies_there(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-03")], "id long, ingest_date string")
    io.write_posts(rows.where("id not in (2, 4)").coalesce(1), str(tmp_path), fmt="parquet")
    listed = io.file_inventory(spark, str(tmp_path))
    out = q_retrieval.inventory_by_date(io.file_rows(spark.read.parquet(str(tmp_path))), listed)
    assert {r.ingest_date: (r.n_files, r.n_rows, r.named, r.sized) for r in out.collect()} == {
        "2024-01-01": (1, 1, True, True), "2024-01-02": (1, 1, True, True)}
    odd = listed.withColumn("size_mb", F.col("size_mb") + 1).withColumn("name", F.concat("name", F.lit("x")))
    out = q_retrieval.inventory_by_date(io.file_rows(spark.read.parquet(str(tmp_path))), odd)
    assert out.where("named or sized").count() == 0


def test_summary_reports_the_rows_of_the_write(spark, monkeypatch):
    posts = spark.read.parquet(f"{SF}/documents.parquet").count()
    got = q_frontier.q_run_summary(spark, SF).first()
    assert got.output_rows == posts and got.has_mb and got.output_files > 1
    write = io.write_posts
    monkeypatch.setattr(io, "write_posts", lambda df, *a, **k: write(df.limit(5), *a, **k))
    assert q_frontier.q_run_summary(spark, SF).first().output_rows == 5


def test_write_reports_rows_without_reading_again(spark):
    path = scratch_path(spark, "t_rows")
    df = spark.range(1000).selectExpr("id", "cast(id % 3 as string) as ingest_date")
    assert io.write_posts(df, path) == 1000
    assert io.write_posts(df.where("id < 0"), path) == 0
    files = io.file_rows(spark.read.parquet(path)).collect()
    assert sum(f.n_rows for f in files) == 1000 and all(f.bytes > 0 and f.name.endswith(".parquet") for f in files)


def test_newest_file(spark):
    path = scratch_path(spark, "t_newest")
    for part in (1, 2, 0):
        io.write_posts(spark.range(part * 10, part * 10 + 5).coalesce(1), path, partition_by=None)
    schema = spark.range(1).schema
    assert sorted(r.id for r in io.newest_file(io.read_posts(spark, path, schema)).collect()) == [0, 1, 2, 3, 4]


def test_newest_landing_of_many_files(spark):
    path = scratch_path(spark, "t_landings")
    for part in (1, 2, 0):
        io.write_posts(spark.range(part * 10, part * 10 + 8, 1, 4), f"{path}/landing={part}", partition_by=None)
    rows = io.read_posts(spark, path, spark.range(1).schema)
    assert sorted(r.id for r in io.newest_file(rows, folders=True).collect()) == list(range(8))


def test_full_files_from_many_tasks(spark):
    for n, tasks in ((1234, 7), (300, 4), (5, 3)):
        df = spark.range(0, n, 1, tasks).selectExpr("id", "repeat('x', cast(id % 5 as int)) as t")
        path = scratch_path(spark, "t_full")
        dealt = io.full_files(df, 100)
        assert dealt.columns == df.columns
        assert io.write_posts(dealt, path, partition_by=None, max_records_per_file=100) == n
        rows = sorted(f.n_rows for f in io.file_rows(spark.read.parquet(path)).collect())
        assert rows == sorted([100] * (n // 100) + [n % 100] * (n % 100 > 0))
        assert spark.read.parquet(path).agg({"id": "sum"}).first()[0] == n * (n - 1) // 2
    # no task holds all rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = io.full_files(spark.range(0, 5000, 1, 4), 100).selectExpr("spark_partition_id() p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1


def test_job_of_a_url_is_not_left_to_chance(spark):
    rows = [("s", "1", "b", 5), ("s", "1", "a", 5), ("s", "1", "z", 4), ("s", "2", None, None), ("s", "2", "t", 0)]
    df = spark.createDataFrame(rows, "subreddit string, id string, title string, score int")
    for n in (1, 5):
        jobs = {r.url: r.metadata for r in FR.post_detail_jobs(df.repartition(n)).collect()}
        assert len(jobs) == 2 and all(('"title":"a"' in m) or ('"title":""' in m) for m in jobs.values())
