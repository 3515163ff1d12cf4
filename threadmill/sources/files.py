"""File sources and sinks.

Posts are written once per run, partitioned by ``ingest_date`` (the
date-directory layout), in Parquet or JSON lines; readers always pass the
fixed schema, so nothing is inferred and partition filters prune directories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import scratch_path


def _fmt(fmt: str | None) -> str:
    """Case-insensitive format switch; anything but jsonl/json means parquet."""
    f = (fmt or C.SAVE_FORMAT).strip().lower()
    return "json" if f in ("jsonl", "json") else "parquet"


def write_posts(df: DataFrame, path: str, fmt: str | None = None, partition_by: str | None = "ingest_date",
                mode: str = "append", max_records_per_file: int | None = None) -> int:
    """One write per batch; an empty batch writes nothing (A3, A4, A5, A7, K8). Returns
    the number of rows, observed while they are written (D3): nothing is read again.

    Batches add files by default. ``overwrite`` replaces the dates the batch
    holds (all files, without ``partition_by``) and leaves other dates alone.

    JSON lines keep null fields (``ignoreNullFields=false``) and write UTF-8
    text unescaped.
    """
    if df.isEmpty():
        return 0
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if _fmt(fmt) == "json":
        w.option("ignoreNullFields", "false").json(path)
    else:
        w.parquet(path)
    return seen.get["rows"]


def read_posts(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None,
               quarantine_col: str | None = None) -> DataFrame:
    """Read posts with a fixed schema (A1, A2, A10).

    JSON lines are read PERMISSIVE: a malformed line becomes a row whose
    ``quarantine_col`` holds the raw text, instead of aborting the read.
    """
    r = spark.read.schema(schema)
    if _fmt(fmt) == "json":
        if quarantine_col:
            s = T.StructType(list(schema.fields) + [T.StructField(quarantine_col, T.StringType())])
            return spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", quarantine_col).json(path)
        return r.json(path)
    return r.parquet(path)


def recent_partitions(df: DataFrame, as_of_date: str, days: int = 7, col: str = "ingest_date",
                      newest: int | None = None) -> DataFrame:
    """Partitions of the last ``days`` days up to ``as_of_date`` (A8); the
    predicate is on the partition column, so directories are pruned. With
    ``newest`` only that many most recent partitions are kept (F5): the
    distinct partition values are few, so ``orderBy().limit()`` is cheap and
    the semi join against them is broadcast by the planner."""
    lo = F.date_format(F.date_sub(F.lit(as_of_date).cast("date"), days - 1), "yyyy-MM-dd")
    out = df.where((F.col(col) >= lo) & (F.col(col) <= F.lit(as_of_date)))
    if newest:
        top = out.select(col).distinct().orderBy(F.col(col).desc()).limit(newest)
        out = out.join(top, col, "left_semi")
    return out


def latest_batch(df: DataFrame, col: str = "batch_id") -> DataFrame:
    """Rows of the newest batch (A9): a left-semi join against the one-row
    max, which the planner broadcasts."""
    top = df.agg(F.max(col).alias(col))
    return df.join(top, col, "left_semi")


def newest_file(df: DataFrame, folders: bool = False) -> DataFrame:
    """Rows of the file that was written last (A9); of files written at one moment the
    last by path. With ``folders``, rows of the whole folder that holds it: a landing
    that many tasks wrote. ``df`` reads files directly; their times are a scalar subquery
    of the plan, taken from file metadata alone."""
    def name(path: Column) -> Column:
        return F.regexp_replace(path, "/[^/]*$", "") if folders else path

    at = F.struct(F.col("_metadata.file_modification_time").alias("t"), F.col("_metadata.file_path").alias("p"))
    rows = df.select("*", name(F.col("_metadata.file_path")).alias("_file"))
    last = df.select(at.alias("at")).agg(F.max("at").alias("at")).select(name(F.col("at.p")))
    return rows.where(F.col("_file") == last.scalar()).drop("_file")


def full_files(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt out by runs of ``rows`` consecutive rows, so that its tasks write files of
    ``rows`` rows each and only one that may hold fewer (with ``max_records_per_file``).
    Rows are numbered by task and place in a stored copy, whatever later reads do."""
    spark = df.sparkSession
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the upper bits are the task
    marked = df.withColumns({"_task": F.spark_partition_id(), "_place": place})
    path = scratch_path(spark, "numbered")
    marked.write.parquet(path)
    marked = spark.read.schema(marked.schema).parquet(path)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = marked.groupBy("_task").agg(F.count(F.lit(1)).alias("n"))  # one row a task
    starts = sizes.select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    dealt = marked.join(F.broadcast(starts), "_task").withColumn("_run", F.expr(f"(_start + _place) div {rows}"))
    return dealt.repartition("_run").select(*df.columns)


def file_rows(df: DataFrame) -> DataFrame:
    """(path, name, bytes, n_rows) of every file that ``df`` reads (A16): no column of the
    rows is read, only file metadata and row counts."""
    m = F.col("_metadata")
    files = df.select(m["file_path"].alias("path"), m["file_name"].alias("name"), m["file_size"].alias("bytes"))
    return files.groupBy("path", "name", "bytes").agg(F.count(F.lit(1)).alias("n_rows"))


def file_inventory(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Output files: name, size in MB (2 dp), modification time; sorted by name.
    Only file metadata is read (``binaryFile`` without the content column)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path"),
        F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"), F.col("modificationTime").alias("modified"),
    ).orderBy("name")


def upsert_by_id(existing: DataFrame, updates: DataFrame, key: str = "chunk_id", version: str | None = None) -> DataFrame:
    """Upsert (A17): the update row wins for a key already present; other
    existing rows are kept. Of several updates for a key the one with the
    largest ``version`` wins (then, or without it, the largest values). For
    whole documents, whose rows may become fewer, see ``operators/index_table``."""
    others = [c for c in updates.columns if c != key]
    order = F.struct(*([version] if version else []), *(c for c in others if c != version))
    new = updates.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(key, "_r.*")
    if version:  # an older update does not replace a newer row; of equal ones the update stays
        both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        rank = F.struct(version, "_new", *(c for c in others if c != version))
        return both.groupBy(key).agg(F.max_by(F.struct(*others), rank).alias("_r")).select(key, "_r.*")
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def write_summary_json(summary: DataFrame, path: str) -> None:
    """Run summary as a single JSON document (A18): the one-row frame is
    written as one JSON-lines file."""
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
