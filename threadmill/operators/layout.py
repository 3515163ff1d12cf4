"""Partition layout guards."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition before CPU-heavy per-row work (tokenising,
    chunking, hashing, scoring) when the planner's size of the frame makes fewer
    splits (``spark.sql.files.maxPartitionBytes``) than the cluster runs tasks at
    once, e.g. a small table stored as one row group. Larger tables (the normal
    case at scale) pass unchanged, so no shuffle is added there. Only the plan's
    statistics are looked at: no job runs and no file is listed to the driver.
    Spark sorts before a round-robin repartition, so a retried task reproduces
    the same rows."""
    spark = df.sparkSession
    target = min_partitions or int(spark.conf.get("spark.default.parallelism", None) or spark.sparkContext.defaultParallelism)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(target) if -(-size // split) < target else df
