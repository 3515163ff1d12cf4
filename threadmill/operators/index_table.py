"""An index table in which a document's rows are replaced as a whole.

The table is a Parquet folder partitioned by ``bucket`` = hash(doc_id) mod
``buckets``, then by ``batch``. A batch names every document it holds with a
version and writes the rows these documents now have; a document without rows
leaves a delete marker that remembers its version. So a batch costs what it
holds, whatever the size of the table, and a replayed batch overwrites exactly
its own partitions (dynamic partition overwrite).

A reader takes, of each document, the rows of the largest version, of equal
versions those of the latest batch; what an edit left behind is stale. It finds
the stale (document, batch) pairs on three narrow columns and drops their rows, so
the wide rows are not shuffled while edits are few.

``compact`` rewrites the buckets that hold many batches as one each (or their newest
batches, see there) and then
removes the old partitions; buckets it does not touch keep their files. Its
output outranks what it was made from, so readers see the same rows before, after
and in between, and a driver lost halfway leaves nothing wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
#: Columns the table adds to the caller's rows.
META = ["version", "deleted", "bucket", "batch"]


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def bucket_of(doc_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def newest(rows: DataFrame, key: str, version: Column) -> DataFrame:
    """One row a key: that of the largest version, of equal ones the largest values."""
    cols = rows.columns
    order = F.struct(version.alias("_v"), *[F.col(c) for c in cols if c != key])
    return rows.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_r")).select("_r.*")


def replace_documents(path: str, rows: DataFrame, docs: DataFrame, batch: int, buckets: int = BUCKETS) -> None:
    """Replace the rows of all documents in ``docs`` (doc_id, version; one row
    each) by ``rows`` (doc_id and any other columns) in the table at ``path``.
    ``batch`` grows from call to call; a repeated one overwrites itself."""
    cols = [c for c in rows.columns if c != "doc_id"]
    mark = rows.withColumn("_has", F.lit(True))
    new = docs.select("doc_id", F.col("version").cast("long").alias("version")).join(mark, "doc_id", "left").select(
        "doc_id", *cols, "version", F.col("_has").isNull().alias("deleted"),
        bucket_of(F.col("doc_id"), buckets).alias("bucket"), F.lit(2 * batch).cast("long").alias("batch"))
    _write(new, path)


def _write(rows: DataFrame, path: str) -> None:
    # one file a bucket where it is small; AQE splits a large one
    rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "bucket", "batch").parquet(path)


def _current(table: DataFrame) -> DataFrame:
    """The rows of each document's largest version, then latest batch."""
    heads = table.select("bucket", "doc_id", "version", "batch").distinct()
    order = F.struct("version", "batch")
    last = heads.groupBy("bucket", "doc_id").agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stale = heads.join(last, ["bucket", "doc_id"]).where(order < F.col("_last")).select("bucket", "doc_id", "version", "batch")
    return table.join(stale, ["bucket", "doc_id", "version", "batch"], "left_anti")


def _newest_run(batches: list) -> list[int]:
    """The newest batches of a bucket (batch, n), oldest of them first, that are worth
    rewriting as one: back to the last that holds no more rows than all newer ones together.
    What stays before them is larger than all after, so a row is rewritten about log2 of
    the number of batches times, however many there will be."""
    batches, newer, take = sorted(batches, reverse=True), 0, 1
    for i, (_, n) in enumerate(batches):
        if n <= newer:
            take = i + 1
        newer += n
    return sorted(batch for batch, _ in batches[:take])


def compact(spark: SparkSession, path: str, min_batches: int = 8, buckets: int = BUCKETS, tiered: bool = False) -> int:
    """Rewrite the buckets of ``min_batches`` batches or more as one batch each; with
    ``tiered`` only their newest batches, as far back as these outweigh an older one, which
    keeps the rewriting in proportion to what was written. Delete
    markers stay, so an older version that lands late is still refused. Returns
    the number of buckets rewritten."""
    table = spark.read.parquet(path)
    held = table.groupBy("bucket", "batch").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.collect_list(F.struct("batch", "n")).alias("batches"))
    due = {}
    for r in held.where(F.size("batches") >= min_batches).collect():  # one row a bucket
        run = _newest_run([(b.batch, b.n) for b in r.batches]) if tiered else sorted(b.batch for b in r.batches)
        if len(run) > 1 or not tiered:
            due[r.bucket] = run
    if not due:
        return 0
    first = F.create_map(*[F.lit(x) for bucket, run in due.items() for x in (bucket, run[0])])
    rows = table.where(F.col("bucket").isin(list(due)) & (F.col("batch") >= F.element_at(first, F.col("bucket"))))
    odd = rows.select("bucket", "doc_id").limit(100).where(F.col("bucket") != bucket_of(F.col("doc_id"), buckets))
    if not odd.isEmpty():
        raise ValueError(f"{path} is not laid out in {buckets} buckets")
    last = F.create_map(*[F.lit(x) for bucket, run in due.items() for x in (bucket, run[-1] | 1)])
    _write(_current(rows).withColumn("batch", F.element_at(last, F.col("bucket")).cast("long")), path)
    for bucket, run in due.items():
        for batch in run:
            if batch != run[-1] | 1:
                _remove(spark, f"{path}/bucket={bucket}/batch={batch}")
    return len(due)


def read_documents(spark: SparkSession, path: str, meta: bool = False) -> DataFrame:
    """The rows of all documents that are not deleted."""
    live = _current(spark.read.parquet(path)).where(~F.col("deleted"))
    return live if meta else live.drop(*META)
