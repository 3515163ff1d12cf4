"""Registered queries: Structured Streaming jobs run one-shot over landed
files (availableNow, several micro-batches), read back from their sinks (K).

Each result must equal the batch twin, which is what the oracle SQL states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import scratch_path
from ..streaming import jobs as SJ
from . import sqlkit as S
from . import views as V
from .q_frontier import JV
from .q_retrieval import CHUNKS_SQL, _w, earlier_draft, posts_for_index
from .registry import query

FILES_PER_TRIGGER = 8
# Landed files are ordered by day but a micro-batch may mix days, so the
# watermark delay must exceed the disorder of the landing (about a month here).
DISORDER = "31 days"


def _land(df: DataFrame, name: str, day_of: str) -> tuple[str, DataFrame]:
    """Write ``df`` as day-partitioned files (one folder and file per day)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"landing_{name}")
    days = df.withColumn("land_day", F.date_format(F.col(day_of), "yyyy-MM-dd")).repartition("land_day")
    days.write.partitionBy("land_day").parquet(path)
    return path, spark.read.parquet(path)


def _dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    return scratch_path(spark, f"sink_{name}"), scratch_path(spark, f"ckpt_{name}")


@query("stream_index", _w(V.POSTS_V_SQL, CHUNKS_SQL) + "SELECT * FROM chunks")
def q_stream_index(spark, sf_dir):
    """Directory watch -> chunk + embed each new file once; a post that lands again
    replaces its chunks (K1, K2, K8, A17). A third of the posts land first with a
    longer draft, a third twice unchanged, some first as a post that is then
    emptied; the index equals the batch chunk table."""
    posts = posts_for_index(spark, sf_dir).withColumn("created_ts", tx.epoch_to_ts("created_utc"))
    first = posts.withColumn("selftext", F.when(F.col("doc_id") % 3 == 0, earlier_draft("selftext")).otherwise(F.col("selftext")))
    gone = posts.where(F.col("doc_id") % 10 == 0).withColumn("id", F.concat(F.lit("gone"), F.col("doc_id").cast("string")))
    landing, landed = _land(first.unionByName(gone), "posts", "created_ts")
    again = posts.where(F.col("doc_id") % 3 < 2)
    emptied = gone.withColumns({"title": F.lit(None).cast("string"), "selftext": F.lit("")})
    again.unionByName(emptied).withColumn("land_day", F.lit("9999-12-31")).write.mode("append").partitionBy("land_day").parquet(landing)
    out, ckpt = _dirs(spark, "index")
    SJ.index_stream(spark, landing, landed.schema, out, ckpt, max_files_per_trigger=FILES_PER_TRIGGER, buckets=16, compact_every=3)
    return SJ.read_index(spark, out).select("chunk_id", "doc_id", "chunk_ix", "chunk_text", "permalink", "subreddit", "score", "created_utc")


@query("stream_index_jsonl", _w(V.POSTS_V_SQL, CHUNKS_SQL) + "SELECT * FROM chunks")
def q_stream_index_jsonl(spark, sf_dir):
    """The indexer over JSON-lines landings that hold malformed lines: these go to
    a quarantine folder, all others are indexed (K1, K5, A2)."""
    posts = posts_for_index(spark, sf_dir).withColumn("land_day", F.date_format(tx.epoch_to_ts("created_utc"), "yyyy-MM-dd"))
    landing = scratch_path(spark, "landing_posts_jsonl")
    posts.write.partitionBy("land_day").option("ignoreNullFields", "false").json(landing)
    bad = V.read(spark, sf_dir, "documents").where(F.col("doc_id") % 100 == 0).select(
        F.concat(F.lit('{"id": "p'), F.col("doc_id").cast("string"), F.lit('", not json')).alias("value"), F.lit("9999-12-31").alias("land_day"))
    bad.write.mode("append").partitionBy("land_day").text(landing)
    out, ckpt = _dirs(spark, "index_jsonl")
    SJ.index_stream(spark, landing, posts.schema, out, ckpt, max_files_per_trigger=FILES_PER_TRIGGER, fmt="json",
                    quarantine_path=scratch_path(spark, "quarantine_jsonl"), buckets=16)
    return SJ.read_index(spark, out).select("chunk_id", "doc_id", "chunk_ix", "chunk_text", "permalink", "subreddit", "score", "created_utc")


def _polls_stream(spark, sf_dir):
    landing, landed = _land(V.polls_v(spark, sf_dir), "polls", "scraped_at")
    return SJ.source(spark, landing, landed.schema, max_files_per_trigger=FILES_PER_TRIGGER)


@query("stream_polls", V.with_views(V.POLLS_V_SQL) + f"""SELECT id, title, score, num_comments, created_utc, subreddit,
  {S.ts('scraped_at')} AS scraped_at FROM polls_v""")
def q_stream_polls(spark, sf_dir):
    """Polls appended batch by batch (K3)."""
    out, ckpt = _dirs(spark, "polls")
    SJ.run(_polls_stream(spark, sf_dir), out, ckpt)
    p = spark.read.parquet(out)
    return p.select("id", "title", "score", "num_comments", "created_utc", "subreddit", tx.ts_text("scraped_at").alias("scraped_at"))


@query("stream_dedupe", V.with_views(V.POLLS_V_SQL) + "SELECT DISTINCT id FROM polls_v")
def q_stream_dedupe(spark, sf_dir):
    """Cross-poll de-duplication with a watermark."""
    out, ckpt = _dirs(spark, "dedupe")
    SJ.run(SJ.dedupe_stream(_polls_stream(spark, sf_dir), delay=DISORDER), out, ckpt)
    return spark.read.parquet(out).select("id")


@query("stream_running_totals", V.with_views(V.POLLS_V_SQL) + "SELECT subreddit, count(*) AS n FROM polls_v GROUP BY 1")
def q_stream_running_totals(spark, sf_dir):
    """Running totals per subreddit, complete mode (K7)."""
    out, ckpt = _dirs(spark, "totals")
    SJ.run_complete(SJ.running_totals(_polls_stream(spark, sf_dir)), out, ckpt)
    return SJ.latest_result(spark, out).select("subreddit", "n")


def _jobs_stream(spark, sf_dir):
    landing, landed = _land(V.jobs_v(spark, sf_dir), "jobs", "created_at")
    return SJ.source(spark, landing, landed.schema, max_files_per_trigger=FILES_PER_TRIGGER)


@query("stream_completion_rate", V.with_views(JV) + f"""SELECT {S.ts('make_timestamp(ws)')} AS window_start,
  {S.ts('make_timestamp(ws + 60000000)')} AS window_end, count(*) AS n
FROM (SELECT CAST(floor(epoch_us(completed_at) / 30000000) AS BIGINT) * 30000000 - k * 30000000 AS ws
      FROM jobs_v, (SELECT unnest([0, 1]) AS k) WHERE status = 'completed')
GROUP BY ws""")
def q_stream_completion_rate(spark, sf_dir):
    """Completions per 1-minute window sliding by 30 s, with a watermark (K6)."""
    out, ckpt = _dirs(spark, "rate")
    SJ.run(SJ.completion_rate(_jobs_stream(spark, sf_dir), delay=DISORDER), out, ckpt, output_mode="update")
    final = SJ.latest_per_key(spark.read.parquet(out), ["window_start", "window_end"])
    return final.select(tx.ts_text("window_start").alias("window_start"), tx.ts_text("window_end").alias("window_end"), "n")


@query("stream_job_state", V.with_views(JV) + """SELECT url, arg_max(id, (created_at, id)) AS id, arg_max(status, (created_at, id)) AS status,
  count(*) AS attempts FROM jobs_v GROUP BY 1""")
def q_stream_job_state(spark, sf_dir):
    """Job state from the attempt log, a native aggregate in update mode (K9)."""
    out, ckpt = _dirs(spark, "jobstate")
    SJ.run(SJ.job_state_stream(_jobs_stream(spark, sf_dir)), out, ckpt, output_mode="update")
    final = SJ.latest_per_key(spark.read.parquet(out), ["url"])
    return final.select("url", "id", "status", "attempts")


# ---------------------------------------------------------------------------
# Late data and the clock: landings that follow one another, with a real watermark
# ---------------------------------------------------------------------------

LANDINGS = 4
LATE_DELAY = "1 day"


def _land_in_order(df: DataFrame, name: str, part, run) -> str:
    """Stand-in input: landings written one after another, by as many tasks as ``df`` has.
    ``part`` numbers them from 0. ``run(path)`` runs a stream after each, with one checkpoint, so
    a landing is a batch whatever its number of files."""
    path = scratch_path(df.sparkSession, f"landing_{name}")
    df = df.withColumn("_part", part)
    for i in range(LANDINGS):
        df.where(F.col("_part") == i).drop("_part").write.mode("append").parquet(path)
        run(path)
    return path


def _landing_of(time: str, late):
    """Landing of an event by its day of the month; those marked late come with the last."""
    by_day = F.least(F.floor((F.dayofmonth(time) - 1) / 8), F.lit(LANDINGS - 1))
    return F.when(late, LANDINGS - 1).otherwise(by_day)


def _late_sql(source: str, time: str, late: str) -> str:
    """CTE ``told``: rows of ``source`` with their landing and whether they come late."""
    return f"""landed AS (
  SELECT *, CASE WHEN {late} THEN {LANDINGS - 1} ELSE least((day({time}) - 1) // 8, {LANDINGS - 1}) END AS part FROM {source}),
marks AS (SELECT part, max({time}) AS mark FROM landed GROUP BY part),
told AS (SELECT l.*, coalesce({time} <= (SELECT max(mark) FROM marks m WHERE m.part < l.part) - INTERVAL {LATE_DELAY}, FALSE) AS late FROM landed l)"""


def _split(spark, df: DataFrame, name: str, time: str, part) -> tuple[str, str]:
    paths = [scratch_path(spark, f"{name}_{x}") for x in ("on_time", "late", "marks", "ckpt")]
    _land_in_order(df, name, part, lambda landing: SJ.split_late(spark, landing, df.schema, time, LATE_DELAY, *paths, max_files_per_trigger=None))
    return paths[0], paths[1]


POLLS_TOLD = V.with_views(V.POLLS_V_SQL, _late_sql("polls_v", "scraped_at", "event_id % 20 = 0"))


def _polls_split(spark, sf_dir):
    polls = V.polls_v(spark, sf_dir)
    return _split(spark, polls, "polls_late", "scraped_at", _landing_of("scraped_at", F.col("event_id") % 20 == 0))


@query("stream_late_rows", POLLS_TOLD + "SELECT event_id, part AS batch_id FROM told WHERE late")
def q_stream_late_rows(spark, sf_dir):
    """Polls that land a day or more behind the newest of earlier landings go to a side
    output with their batch, instead of being dropped unseen (K4, K6)."""
    _, late = _polls_split(spark, sf_dir)
    return spark.read.parquet(late).select("event_id", F.col("batch_id").cast("bigint").alias("batch_id"))


@query("stream_dedupe_in_time", POLLS_TOLD + """SELECT DISTINCT event_id FROM told WHERE NOT late""")
def q_stream_dedupe_in_time(spark, sf_dir):
    """De-duplication of rows that land twice, with a watermark of a day (K4): state
    expires, and late rows are kept apart beforehand."""
    on_time, _ = _polls_split(spark, sf_dir)
    twice = spark.read.parquet(on_time).drop("batch_id")
    out, ckpt = _dirs(spark, "dedupe_in_time")

    def dedupe(landing):
        SJ.run(SJ.dedupe_stream(SJ.source(spark, landing, twice.schema), key="event_id", delay=LATE_DELAY), out, ckpt)

    _land_in_order(twice.unionByName(twice), "polls_twice", _landing_of("scraped_at", F.lit(False)), dedupe)
    return spark.read.parquet(out).select("event_id")


JOBS_TOLD = V.with_views(JV, _late_sql("(SELECT * FROM jobs_v WHERE status = 'completed')", "completed_at", "id % 20 = 0"))


@query("stream_completion_rate_in_time", JOBS_TOLD + f"""SELECT {S.ts('make_timestamp(ws)')} AS window_start,
  {S.ts('make_timestamp(ws + 60000000)')} AS window_end, count(*) AS n
FROM (SELECT CAST(floor(epoch_us(completed_at) / 30000000) AS BIGINT) * 30000000 - k * 30000000 AS ws
      FROM told, (SELECT unnest([0, 1]) AS k) WHERE NOT late)
GROUP BY ws""")
def q_stream_completion_rate_in_time(spark, sf_dir):
    """Completions per window with a watermark of a day (K6): closed windows leave the state."""
    done = V.jobs_v(spark, sf_dir).where(F.col("status") == "completed")
    on_time, _ = _split(spark, done, "jobs_late", "completed_at", _landing_of("completed_at", F.col("id") % 20 == 0))
    rows = spark.read.parquet(on_time).drop("batch_id")
    out, ckpt = _dirs(spark, "rate_in_time")

    def rate(landing):
        SJ.run(SJ.completion_rate(SJ.source(spark, landing, rows.schema), delay=LATE_DELAY), out, ckpt, output_mode="update")

    _land_in_order(rows, "jobs_in_time", _landing_of("completed_at", F.lit(False)), rate)
    final = SJ.latest_per_key(spark.read.parquet(out), ["window_start", "window_end"])
    return final.select(tx.ts_text("window_start").alias("window_start"), tx.ts_text("window_end").alias("window_end"), "n")


@query("stream_stalled_jobs", V.with_views(JV) + f"""SELECT url, id, {S.ts("created_at + INTERVAL 6 HOUR")} AS stalled_at FROM (
  SELECT url, id, status, to_ms, lead(to_ms) OVER (PARTITION BY url ORDER BY to_ms, id) AS next, make_timestamp(to_ms * 1000) AS created_at
  FROM (SELECT *, CAST(floor(epoch_us(created_at) / 1000) AS BIGINT) AS to_ms FROM jobs_v))
WHERE status = 'in_progress' AND (next IS NULL OR next > to_ms + 6 * 3600000)""")
def q_stream_stalled_jobs(spark, sf_dir):
    """Jobs in progress that nothing followed for six hours, found by event-time timers;
    the state of a URL expires (K9). A last row far ahead moves the clock on."""
    jobs = V.jobs_v(spark, sf_dir).select("id", "url", "status", "created_at")
    clock = spark.range(1).select(F.lit(-1).cast("bigint").alias("id"), F.lit("clock").alias("url"), F.lit("pending").alias("status"),
                                  F.lit("2100-01-01").cast("timestamp").alias("created_at"))
    out, ckpt = _dirs(spark, "stalled")

    def stalled(landing):
        stream = SJ.source(spark, landing, jobs.schema)
        SJ.run_stateful(SJ.stalled_jobs(stream, stall="6 hours", keep="3 days", delay="1 minute"), out, ckpt)

    landing = _land_in_order(jobs, "attempts", _landing_of("created_at", F.lit(False)), stalled)
    clock.coalesce(1).write.mode("append").parquet(landing)
    stalled(landing)
    return spark.read.parquet(out).select("url", "id", tx.ts_text("stalled_at").alias("stalled_at"))
