"""Incremental versions of indexing, polling, de-duplication and monitoring (K1-K9).

Every job reads a landed directory with a fixed schema (file source with a
checkpoint, so each file is processed once, across restarts too), and writes
through ``foreachBatch`` with batch-id-scoped output folders: replaying a
micro-batch after a failure overwrites exactly what that batch wrote, so the
sinks are idempotent. ``trigger`` is ``{"availableNow": True}`` for one-shot
runs or ``{"processingTime": "10 seconds"}`` for a watch loop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ChunkSpec
from ..operators import chunks as CH
from ..operators import index_table as IX
from ..operators import vectors as VE
from ..sources.files import latest_batch

ONE_SHOT = {"availableNow": True}
WATCH = {"processingTime": "10 seconds"}


def source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
           max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _batch_writer(out_path: str, fmt: str = "parquet", transform: Callable[[DataFrame], DataFrame] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        df = transform(batch) if transform else batch
        df.write.mode("overwrite").format(fmt).save(f"{out_path}/batch_id={batch_id}")
    return write


def run(stream: DataFrame, out_path: str, checkpoint: str, trigger: dict = ONE_SHOT,
        transform: Callable[[DataFrame], DataFrame] | None = None, output_mode: str = "append", wait: bool = True):
    """Start ``stream`` -> idempotent foreachBatch sink; wait when one-shot."""
    q = (stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(_batch_writer(out_path, transform=transform)).trigger(**trigger).start())
    if wait:
        q.awaitTermination()
    return q


def read_sink(spark: SparkSession, out_path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(T.StructType(list(schema.fields) + [T.StructField("batch_id", T.LongType())]))
    return r.parquet(out_path)


# ---------------------------------------------------------------------------
# K1/K2: directory indexer
# ---------------------------------------------------------------------------

def index_posts(posts: DataFrame, spec: ChunkSpec = ChunkSpec(), embed: bool = True,
                chunker: Callable[[DataFrame, ChunkSpec], DataFrame] = CH.post_chunks) -> DataFrame:
    """One micro-batch of posts (or, with ``chunker=comment_chunks``, comments)
    -> chunk rows (+ hashed embedding)."""
    ch = chunker(posts, spec)
    return VE.embed_hashed(ch, "chunk_text") if embed else ch


def index_batch(batch: DataFrame, out_path: str, batch_id: int, version: Column, spec: ChunkSpec = ChunkSpec(),
                buckets: int = IX.BUCKETS, chunker: Callable[[DataFrame, ChunkSpec], DataFrame] = CH.post_chunks,
                id_col: str = "id") -> None:
    """Index ``batch``: the chunks of every document in it replace those it had
    before, however many these were (A17). A document that stands in the batch
    twice counts with its larger version."""
    one = IX.newest(batch.withColumn("_version", version.cast("long")), id_col, F.col("_version"))
    docs = one.select(F.col(id_col).cast("string").alias("doc_id"), F.col("_version").alias("version")).dropna(subset=["doc_id"])
    IX.replace_documents(out_path, index_posts(one.drop("_version"), spec, chunker=chunker), docs, batch_id, buckets)


def index_stream(spark: SparkSession, landing: str, schema: T.StructType, out_path: str, checkpoint: str,
                 trigger: dict = ONE_SHOT, max_files_per_trigger: int | None = 1, spec: ChunkSpec = ChunkSpec(),
                 fmt: str = "parquet", quarantine_path: str | None = None,
                 chunker: Callable[[DataFrame, ChunkSpec], DataFrame] = CH.post_chunks,
                 version: str | None = None, buckets: int = IX.BUCKETS, compact_every: int = 16):
    """Watch ``landing`` and index every new file once (K1; one-shot K2): posts,
    or comments with ``chunker=comment_chunks``.

    A post that lands again replaces its chunks. Its version is the column
    ``version``, or the time its file was written. In buckets of ``compact_every``
    batches the newest are rewritten as one, as far back as they outweigh an older one.

    ``fmt`` is ``parquet`` or ``json`` (JSON lines). JSON is read PERMISSIVE:
    a malformed line does not fail the batch (K5) but is written, with its
    batch id, under ``quarantine_path`` (B19) while the good rows are indexed.
    """
    bad_col = "_corrupt_record"
    json = fmt == "json"
    full = T.StructType(list(schema.fields) + [T.StructField(bad_col, T.StringType())]) if json else schema
    r = spark.readStream.schema(full).format(fmt)
    if json:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_col)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.load(landing).withColumn("_landed", F.unix_millis(F.col("_metadata.file_modification_time")))
    by = F.col(version) if version else F.col("_landed")

    def write(batch: DataFrame, batch_id: int) -> None:
        if json:
            if quarantine_path:
                # a data column beside the raw line: Spark reads no corrupt lines alone
                bad = batch.where(F.col(bad_col).isNotNull()).select(bad_col, schema.names[0])
                bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
            batch = batch.where(F.col(bad_col).isNull()).drop(bad_col)
        index_batch(batch, out_path, batch_id, by, spec, buckets, chunker)
        if batch_id % compact_every == compact_every - 1:
            IX.compact(batch.sparkSession, out_path, compact_every, buckets, tiered=True)

    q = s.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()
    if "availableNow" in trigger or "once" in trigger:
        q.awaitTermination()
    return q


# ---------------------------------------------------------------------------
# K3/K4: polls and cross-poll de-duplication
# ---------------------------------------------------------------------------

def dedupe_stream(polls: DataFrame, key: str = "id", event_time: str = "scraped_at", delay: str = "1 day") -> DataFrame:
    """First sighting per key within the watermark (K4; fixes X6). State per
    key is dropped once the watermark passes, so it stays bounded."""
    return polls.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def running_totals(polls: DataFrame, key: str = "subreddit") -> DataFrame:
    """Running count per key across all polls (K7, complete mode)."""
    return polls.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def run_complete(stream: DataFrame, out_path: str, checkpoint: str, trigger: dict = ONE_SHOT):
    """Complete-mode aggregate: each batch writes the whole (small, per-key)
    result into a folder of its own; ``latest_result`` reads the last one, so a
    reader never sees half a result and a replayed batch replaces itself."""
    return run(stream, out_path, checkpoint, trigger, output_mode="complete")


def latest_result(spark: SparkSession, out_path: str) -> DataFrame:
    """The result of the newest batch under ``out_path``."""
    return latest_batch(spark.read.parquet(out_path), "batch_id").drop("batch_id")


def read_index(spark: SparkSession, out_path: str) -> DataFrame:
    """The chunks behind an ``index_stream`` sink, one set a document."""
    return IX.read_documents(spark, out_path)


# ---------------------------------------------------------------------------
# Late rows
# ---------------------------------------------------------------------------

def split_late(spark: SparkSession, landing: str, schema: T.StructType, event_time: str, delay: str, on_time_path: str,
               late_path: str, marks_path: str, checkpoint: str, trigger: dict = ONE_SHOT, max_files_per_trigger: int | None = 1,
               fmt: str = "parquet"):
    """Part a stream into rows in time and late rows, instead of losing these in a
    stateful operator. A row is late if its event time is ``delay`` or more behind the
    largest of all *earlier* batches. Both kinds are written by batch; the largest time of
    a batch is kept under ``marks_path``, written last, so a replayed batch is judged by
    the same mark. Rows without an event time are late. A stateful job that reads
    ``on_time_path`` with a watermark of ``delay`` drops nothing."""
    at = F.col(event_time)

    def write(batch: DataFrame, batch_id: int) -> None:
        marks = "batch_id long, mark timestamp"
        before = spark.read.schema(marks).parquet(marks_path) if batch_id else spark.createDataFrame([], marks)
        mark = before.where(F.col("batch_id") < batch_id).agg(F.max("mark").alias("_mark"))
        told = batch.crossJoin(F.broadcast(mark))  # one row
        late = at.isNull() | F.coalesce(at <= F.col("_mark") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        for path, rows in ((on_time_path, told.where(~late)), (late_path, told.where(late))):
            rows.drop("_mark").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        own = batch.agg(F.lit(batch_id).cast("long").alias("batch_id"), F.max(at).alias("mark"))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(marks_path)

    s = source(spark, landing, schema, fmt, max_files_per_trigger)
    q = s.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()
    if "availableNow" in trigger or "once" in trigger:
        q.awaitTermination()
    return q


# ---------------------------------------------------------------------------
# K6: trailing-minute completion rate
# ---------------------------------------------------------------------------

def completion_rate(jobs: DataFrame, delay: str = "10 minutes", size: str = "1 minute", slide: str = "30 seconds") -> DataFrame:
    """Completed jobs per sliding window (K6). Update mode: each batch emits
    changed windows; windows older than the watermark leave the state."""
    done = jobs.where(F.col("status") == "completed").withWatermark("completed_at", delay)
    return done.groupBy(F.window("completed_at", size, slide).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def latest_per_key(sink: DataFrame, keys: list[str]) -> DataFrame:
    """Final value per key from an update-mode sink: the row of the last batch; of
    several rows in that batch the one with the largest values."""
    others = [c for c in sink.columns if c not in keys and c != "batch_id"]
    order = F.struct("batch_id", *others)
    return sink.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_r")).select(*keys, "_r.*")


# ---------------------------------------------------------------------------
# K9: job state from an event log
# ---------------------------------------------------------------------------

def job_state_stream(attempts: DataFrame) -> DataFrame:
    """Current state per job URL from an attempt log (K9), as a native aggregate
    in update mode: partial aggregation reduces a hot URL inside each map task,
    and the state of a URL is its latest attempt and a count."""
    order = F.struct(F.unix_micros("created_at").alias("us"), F.col("id").alias("i"))
    return attempts.groupBy("url").agg(
        F.max_by(F.struct("id", "status"), order).alias("_s"),
        F.count(F.lit(1)).alias("attempts"),
        F.max(F.unix_micros("created_at")).alias("last_us"),
    ).select("url", "_s.id", "_s.status", "attempts", "last_us")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STALLED = "url string, id long, stalled_at timestamp"


def _stall_processor(stall_ms: int, keep_ms: int):
    """Keeps the latest attempt of a URL. An attempt in progress that is followed by none
    for ``stall_ms`` is reported: by the next attempt, or by a timer once the watermark
    has passed. The state of a URL goes ``keep_ms`` after its last attempt."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Stalls(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.last = handle.getValueState("last", "id long, status string, at long")

        def _rows(self, url, found):
            # plain object strings: Arrow-backed ones come as chunks, which the worker cannot nest
            return pd.DataFrame({"url": pd.Series([url] * len(found), dtype=object), "id": pd.Series([i for i, _ in found], dtype="int64"),
                                 "stalled_at": pd.to_datetime([t + stall_ms for _, t in found], unit="ms")})

        def _timers(self, at, open_):
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t[0] if isinstance(t, (tuple, list)) else t)
            self.handle.registerTimer(at + (stall_ms if open_ else keep_ms))

        def handleInputRows(self, key, rows, timerValues):
            new = [r for b in rows for r in zip(b["at"].tolist(), b["id"].tolist(), b["status"].tolist())]
            if self.last.exists():
                i, status, at = self.last.get()
                new.append((at, i, status))
            new.sort()
            found = [(i, t) for (t, i, status), (after, _, _) in zip(new, new[1:]) if status == "in_progress" and after > t + stall_ms]
            at, i, status = new[-1]
            self.last.update((i, status, at))
            self._timers(at, status == "in_progress")
            yield self._rows(key[0], found)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            i, status, at = self.last.get()
            if status == "in_progress":  # nothing came after it
                self.last.update((i, "stalled", at))
                self.handle.registerTimer(at + max(keep_ms, stall_ms + 1))
                yield self._rows(key[0], [(i, at)])
            else:
                self.last.clear()
                yield self._rows(key[0], [])

        def close(self):
            pass

    return Stalls()


def stalled_jobs(attempts: DataFrame, stall: str = "10 minutes", keep: str = "1 day", delay: str = "1 minute") -> DataFrame:
    """Attempts in progress that nothing followed for ``stall`` (K9), in event time: one
    row (url, id, stalled_at) each, as soon as the watermark shows it. An attempt log
    (id, url, status, created_at) comes in; a URL's state goes ``keep`` after its last attempt."""
    import pandas as pd

    ms = [int(pd.Timedelta(x).total_seconds() * 1000) for x in (stall, keep)]
    rows = attempts.select("url", "id", "status", "created_at", F.unix_millis("created_at").alias("at"))
    return rows.withWatermark("created_at", delay).groupBy("url").transformWithStateInPandas(
        _stall_processor(*ms), outputStructType=STALLED, outputMode="Append", timeMode="EventTime")


def run_stateful(stream: DataFrame, out_path: str, checkpoint: str, trigger: dict = ONE_SHOT):
    """Run a ``transformWithState`` stream: it needs the RocksDB state store, which is set
    for this query only."""
    spark = stream.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        q = run(stream, out_path, checkpoint, trigger, wait=False)
    finally:
        spark.conf.set(key, old) if old else spark.conf.unset(key)
    if "availableNow" in trigger or "once" in trigger:
        q.awaitTermination()
    return q
