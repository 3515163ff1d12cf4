"""Physical-plan checks: pushdown, pruning, bounded top-k, entry contract."""

from pyspark.sql import functions as F

from threadmill.operators import frontier as FR
from threadmill.operators import posts as P
from threadmill.operators import threads as TH
from threadmill.plans import views as V

from conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_pushed_into_scan(spark):
    vec = V.read(spark, SF, "embeddings").where(P.payload_filter({"label": 3}))
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)]" in plan(vec)
    # created_utc is DOUBLE in the post schema: the recency bound is pushed as is.
    ev = P.recent(V.read(spark, SF, "events").withColumnRenamed("value", "created_utc"), 1000000.0).select("event_id")
    p = plan(ev)
    assert "GreaterThanOrEqual(value," in p and "ReadSchema: struct<event_id:bigint,value:double>" in p


def test_partition_pruning(spark, tmp_path_factory):
    from threadmill.session import scratch_path
    path = scratch_path(spark, "t_part")
    V.read(spark, SF, "events").withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    df = spark.read.parquet(path).where(F.col("day") == F.lit("2024-01-03").cast("date"))
    assert "PartitionFilters: [isnotnull(day" in plan(df)


def test_window_group_limit_and_take_ordered(spark):
    c = V.comments_v(spark, SF).withColumn("path", F.array("turn"))
    assert "WindowGroupLimit" in plan(TH.cap_per_post(c, 3))
    j = V.jobs_v(spark, SF)
    assert "TakeOrderedAndProject" in plan(FR.next_jobs(j, 5))


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["query_id", "system_prompt", "user_prompt"]
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 90
