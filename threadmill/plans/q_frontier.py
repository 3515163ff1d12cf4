"""Registered queries: crawl frontier / job table (J, C5-C7, D4-D10, E4, E5, F3, F4, G-U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as tx
from ..operators import frontier as FR
from ..sources import json_docs as jd
from . import sqlkit as S
from . import views as V
from .q_posts import PAGES_SQL, listing_pages
from .registry import query

W = V.with_views
JV = V.JOBS_V_SQL
AS_OF_SQL = "(SELECT max(completed_at) FROM jobs_v)"
N_NEXT = 50
CAP = 1000
SPLIT = "2024-01-15 00:00:00"


def _as_of(jobs):
    """``as_of`` = latest completion in the table: a scalar subquery of the same
    plan (keeps the trailing-minute report non-empty)."""
    return jobs.agg(F.max("completed_at")).scalar()


def _jobs_out(df):
    return df.select("id", "status", "retry_count", "worker_id", tx.ts_text("started_at").alias("started_at"),
                     tx.ts_text("completed_at").alias("completed_at"), "error_message")


JOBS_OUT_SQL = f"id, status, retry_count, worker_id, {S.ts('started_at')} AS started_at, {S.ts('completed_at')} AS completed_at, error_message"


@query("job_status_counts", W(JV) + """SELECT count(*) AS total,
  CAST(sum(CASE WHEN status = 'pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending,
  CAST(sum(CASE WHEN status = 'in_progress' THEN 1 ELSE 0 END) AS BIGINT) AS in_progress,
  CAST(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
  CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN status = 'retry' THEN 1 ELSE 0 END) AS BIGINT) AS retry FROM jobs_v""")
def q_job_status_counts(spark, sf_dir):
    """Status breakdown in one row."""
    j = V.jobs_v(spark, sf_dir)
    return FR.job_stats(j).select("total", "pending", "in_progress", "completed", "failed", "retry")


@query("job_avg_duration", W(JV) + """SELECT round(avg((epoch_us(completed_at) - epoch_us(started_at)) / 1e6), 6) AS avg_duration_seconds
FROM jobs_v WHERE status = 'completed' AND completed_at IS NOT NULL AND started_at IS NOT NULL""")
def q_job_avg_duration(spark, sf_dir):
    """Mean duration of completed jobs in seconds."""
    j = V.jobs_v(spark, sf_dir)
    return FR.job_stats(j).select("avg_duration_seconds")


@query("jobs_last_minute", W(JV) + f"""SELECT count(*) AS jobs_per_minute FROM jobs_v
WHERE status = 'completed' AND completed_at > make_timestamp(epoch_us({AS_OF_SQL}) - 60000000)""")
def q_jobs_last_minute(spark, sf_dir):
    """Completions in the trailing minute, strict."""
    j = V.jobs_v(spark, sf_dir)
    return FR.job_stats(j, _as_of(j)).select("jobs_per_minute")


@query("job_stats", W(JV) + f"""SELECT count(*) AS total,
  CAST(sum(CASE WHEN status = 'pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending,
  CAST(sum(CASE WHEN status = 'in_progress' THEN 1 ELSE 0 END) AS BIGINT) AS in_progress,
  CAST(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
  CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN status = 'retry' THEN 1 ELSE 0 END) AS BIGINT) AS retry,
  round(avg(CASE WHEN status = 'completed' AND completed_at IS NOT NULL AND started_at IS NOT NULL
                 THEN (epoch_us(completed_at) - epoch_us(started_at)) / 1e6 END), 6) AS avg_duration_seconds,
  count(*) FILTER (WHERE status = 'completed' AND completed_at > make_timestamp(epoch_us({AS_OF_SQL}) - 60000000)) AS jobs_per_minute
FROM jobs_v""")
def q_job_stats(spark, sf_dir):
    """Queue report in one row: counts, mean duration, trailing-minute rate."""
    j = V.jobs_v(spark, sf_dir)
    return FR.job_stats(j, _as_of(j))


@query("open_job_count", W(JV) + "SELECT count(*) AS open_jobs FROM jobs_v WHERE status IN ('pending', 'retry')")
def q_open_job_count(spark, sf_dir):
    """Pending + retry."""
    return FR.open_job_count(V.jobs_v(spark, sf_dir))


@query("job_progress", W(JV) + """SELECT total, completed, failed,
  round(completed / greatest(total, 1) * 100, 2) AS success_rate,
  round((completed + failed) / greatest(total, 1) * 100, 2) AS progress_pct
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed') AS completed,
             count(*) FILTER (WHERE status = 'failed') AS failed FROM jobs_v)""")
def q_job_progress(spark, sf_dir):
    """Success rate and progress percentages, rounded to 2 places."""
    j = V.jobs_v(spark, sf_dir)
    return FR.job_progress(FR.job_stats(j))


@query("worker_stats", W(JV, V.RESULTS_V_SQL) + """SELECT worker_id, count(*) FILTER (WHERE status = 'completed') AS jobs_completed,
  count(*) FILTER (WHERE status = 'failed') AS jobs_failed, CAST(sum(coalesce(r.rec, 0)) AS BIGINT) AS total_records,
  round(count(*) FILTER (WHERE status = 'completed') / greatest(coalesce((max(epoch_us(completed_at)) - min(epoch_us(started_at))) / 1e6, 0.0), 1.0) * 60, 2) AS jobs_per_minute
FROM jobs_v j LEFT JOIN (SELECT job_id, sum(record_count) AS rec FROM results_v GROUP BY 1) r ON r.job_id = j.id
WHERE worker_id IS NOT NULL GROUP BY 1""")
def q_worker_stats(spark, sf_dir):
    """Per-worker completed/failed/records/jobs per minute."""
    return FR.worker_stats(V.jobs_v(spark, sf_dir), V.results_v(spark, sf_dir))


@query("distinct_urls", W(JV) + """SELECT url, min(id) AS id FROM jobs_v GROUP BY 1""")
def q_distinct_urls(spark, sf_dir):
    """URL de-duplication, first insert wins."""
    return FR.distinct_urls(V.jobs_v(spark, sf_dir)).select("url", "id")


@query("next_jobs", W(JV) + f"""SELECT id, priority, {S.ts('created_at')} AS created_at FROM jobs_v
WHERE status = 'pending' OR (status = 'retry' AND retry_count < {C.MAX_RETRIES})
ORDER BY priority DESC, created_at ASC, id ASC LIMIT {N_NEXT}""")
def q_next_jobs(spark, sf_dir):
    """Next batch of eligible jobs in priority order."""
    return FR.next_jobs(V.jobs_v(spark, sf_dir), N_NEXT).select("id", "priority", tx.ts_text("created_at").alias("created_at"))


@query("claim_jobs", W(JV) + f"""SELECT id,
  CASE WHEN picked THEN 'in_progress' ELSE status END AS status, retry_count,
  CASE WHEN picked THEN 'w-batch' ELSE worker_id END AS worker_id,
  {S.ts(f"CASE WHEN picked THEN {AS_OF_SQL} ELSE started_at END")} AS started_at, {S.ts('completed_at')} AS completed_at, error_message
FROM (SELECT *, id IN (SELECT id FROM jobs_v WHERE status = 'pending' OR (status = 'retry' AND retry_count < {C.MAX_RETRIES})
                        ORDER BY priority DESC, created_at ASC, id ASC LIMIT {N_NEXT}) AS picked FROM jobs_v)""")
def q_claim_jobs(spark, sf_dir):
    """Claim transition for the next batch: in_progress, worker, started_at."""
    j = V.jobs_v(spark, sf_dir)
    as_of = _as_of(j)
    return _jobs_out(FR.claim(j, FR.next_jobs(j, N_NEXT), "w-batch", as_of))


_OUTCOME_K = "CAST(json_extract(metadata, '$.k') AS BIGINT)"


def _outcomes(j, done: bool):
    k = F.get_json_object("metadata", "$.k").cast("bigint")
    o = j.where((F.col("status") == C.JOB_IN_PROGRESS) & ((k < 50) if done else (k >= 50)))
    return o.select("id", F.timestamp_micros(F.unix_micros("started_at") + k * 1_000_000).alias("finished_at"),
                    F.concat(F.lit("timeout after "), k.cast("string"), F.lit(" s")).alias("error"))


@query("apply_completions", W(JV) + f"""SELECT id, CASE WHEN hit THEN 'completed' ELSE status END AS status, retry_count, worker_id,
  {S.ts('started_at')} AS started_at,
  {S.ts(f"CASE WHEN hit THEN make_timestamp(epoch_us(started_at) + {_OUTCOME_K} * 1000000) ELSE completed_at END")} AS completed_at, error_message
FROM (SELECT *, status = 'in_progress' AND {_OUTCOME_K} < 50 AS hit FROM jobs_v)""")
def q_apply_completions(spark, sf_dir):
    """Completion outcomes applied to the table."""
    j = V.jobs_v(spark, sf_dir)
    return _jobs_out(FR.apply_completions(j, _outcomes(j, True)))


@query("apply_failures", W(JV) + f"""SELECT id,
  CASE WHEN hit AND retry_count + 1 < {C.MAX_RETRIES} THEN 'retry' WHEN hit THEN 'failed' ELSE status END AS status,
  CASE WHEN hit AND retry_count + 1 < {C.MAX_RETRIES} THEN retry_count + 1 ELSE retry_count END AS retry_count,
  CASE WHEN hit AND retry_count + 1 < {C.MAX_RETRIES} THEN NULL ELSE worker_id END AS worker_id,
  {S.ts('started_at')} AS started_at,
  {S.ts(f"CASE WHEN hit AND NOT (retry_count + 1 < {C.MAX_RETRIES}) THEN make_timestamp(epoch_us(started_at) + {_OUTCOME_K} * 1000000) ELSE completed_at END")} AS completed_at,
  CASE WHEN hit THEN 'timeout after ' || CAST({_OUTCOME_K} AS VARCHAR) || ' s' ELSE error_message END AS error_message
FROM (SELECT *, status = 'in_progress' AND {_OUTCOME_K} >= 50 AS hit FROM jobs_v)""")
def q_apply_failures(spark, sf_dir):
    """Failure outcomes: retry with count + 1, or failed when retries are
    exhausted (J7, S22, X2)."""
    j = V.jobs_v(spark, sf_dir)
    return _jobs_out(FR.apply_failures(j, _outcomes(j, False)))


@query("reset_stalled", W(JV) + f"""SELECT id, CASE WHEN st AND retry_count + 1 >= {C.MAX_RETRIES} THEN 'failed' WHEN st THEN 'retry' ELSE status END AS status,
  CASE WHEN st THEN retry_count + 1 ELSE retry_count END AS retry_count, CASE WHEN st THEN NULL ELSE worker_id END AS worker_id,
  {S.ts('started_at')} AS started_at, {S.ts('completed_at')} AS completed_at, error_message
FROM (SELECT *, coalesce(status = 'in_progress' AND started_at < make_timestamp(epoch_us({AS_OF_SQL}) - {C.STALL_TIMEOUT_MINUTES * 60}000000), FALSE) AS st FROM jobs_v)""")
def q_reset_stalled(spark, sf_dir):
    """In progress for more than 30 minutes -> retry, +1, or failed where retries are exhausted."""
    j = V.jobs_v(spark, sf_dir)
    return _jobs_out(FR.reset_stalled(j, _as_of(j)))


@query("retention", W(JV) + f"""SELECT id, status FROM jobs_v WHERE NOT coalesce(status IN ('completed', 'failed')
  AND completed_at < make_timestamp(epoch_us({AS_OF_SQL}) - {C.CLEANUP_DAYS * 86400}000000), FALSE)""")
def q_retention(spark, sf_dir):
    """Drop finished jobs older than 7 days; NULL completed_at is kept."""
    j = V.jobs_v(spark, sf_dir)
    return FR.retention(j, _as_of(j)).select("id", "status")


@query("frontier_insert_new", W(JV) + f"""SELECT url, min(id) AS id, arg_min(priority, id) AS priority FROM jobs_v c
WHERE created_at >= TIMESTAMP '{SPLIT}' AND NOT EXISTS (SELECT 1 FROM jobs_v e WHERE e.created_at < TIMESTAMP '{SPLIT}' AND e.url = c.url)
GROUP BY url""")
def q_frontier_insert_new(spark, sf_dir):
    """Insert-or-ignore of newly discovered URLs into the frontier."""
    j = V.jobs_v(spark, sf_dir)
    split = F.lit(SPLIT).cast("timestamp")
    existing = j.where(F.col("created_at") < split)
    cand = j.where(F.col("created_at") >= split)
    return FR.insert_new(existing, cand).select("url", "id", "priority")


@query("frontier_cap", W(JV) + f"""SELECT url, priority FROM (SELECT url, max(priority) AS priority FROM jobs_v GROUP BY 1)
ORDER BY priority DESC, url LIMIT {CAP}""")
def q_frontier_cap(spark, sf_dir):
    """At most N discovered URLs by priority then URL."""
    j = V.jobs_v(spark, sf_dir).groupBy("url").agg(F.max("priority").alias("priority"))
    return FR.frontier_cap(j, CAP)


@query("except_seen", W(JV) + "SELECT DISTINCT url FROM jobs_v EXCEPT SELECT url FROM jobs_v WHERE status = 'completed'")
def q_except_seen(spark, sf_dir):
    """URLs not yet completed: set difference via left anti join (G-U4)."""
    j = V.jobs_v(spark, sf_dir)
    done = j.where(F.col("status") == C.JOB_COMPLETED).select("url")
    return j.select("url").distinct().join(done, "url", "left_anti")


@query("job_results", W(JV, V.RESULTS_V_SQL) + """SELECT j.id, j.status, r.data_path, r.record_count
FROM jobs_v j LEFT JOIN results_v r ON r.job_id = j.id""")
def q_job_results(spark, sf_dir):
    """Every job with its result rows."""
    return FR.job_results(V.jobs_v(spark, sf_dir), V.results_v(spark, sf_dir)).select("id", "status", "data_path", "record_count")


@query("job_current_state", W(JV) + f"""SELECT url, arg_max(id, (created_at, id)) AS id, arg_max(status, (created_at, id)) AS status,
  count(*) AS attempts FROM jobs_v GROUP BY 1""")
def q_job_current_state(spark, sf_dir):
    """Attempt history -> latest state per URL (E5)."""
    return FR.current_state(V.jobs_v(spark, sf_dir), "url").select("url", "id", "status", "attempts")


def _crawl_plan(spark, sf_dir):
    subs = V.posts_v(spark, sf_dir).select("subreddit").distinct()
    docs = jd.parse_bodies(listing_pages(spark, sf_dir))
    tokens = jd.next_page_tokens(docs, keep=("subreddit", "page")).withColumn("sort_type", F.lit("new"))
    return FR.crawl_plan(subs, C.PAGES_PER_SUBREDDIT, tokens=tokens)


CRAWL_PLAN_SQL = W(V.POSTS_V_SQL, PAGES_SQL) + f""", every_page AS (
  SELECT s.subreddit, t.sort_type, p.page_ix, pg.after
  FROM (SELECT DISTINCT subreddit FROM posts_v) s, (SELECT unnest(['new', 'hot', 'top']) AS sort_type) t,
       (SELECT unnest(range(0, {C.PAGES_PER_SUBREDDIT})) AS page_ix) p
  LEFT JOIN pages_v pg ON pg.subreddit = s.subreddit AND t.sort_type = 'new' AND pg.page = p.page_ix AND pg.after IS NOT NULL),
plan AS (SELECT * FROM every_page QUALIFY count(*) FILTER (WHERE page_ix > 0 AND after IS NULL)
  OVER (PARTITION BY subreddit, sort_type ORDER BY page_ix) = 0)
"""
CRAWL_PLAN_COLS = f"""subreddit, sort_type, page_ix + 1 AS page,
  {S.lit(C.SITE_BASE + '/r/')} || subreddit || '/' || sort_type || '.json' || CASE WHEN after IS NOT NULL THEN '?after=' || after || '&limit=100' ELSE '?limit=100' END AS url,
  CAST({C.FIRST_PAGE_PRIORITY} - page_ix AS INTEGER) AS priority"""


@query("crawl_plan", CRAWL_PLAN_SQL + f"SELECT {CRAWL_PLAN_COLS} FROM plan")
def q_crawl_plan(spark, sf_dir):
    """Subreddits x sorts x pages with pagination tokens from landed listings."""
    return _crawl_plan(spark, sf_dir).select("subreddit", "sort_type", F.col("page").cast("bigint").alias("page"), "url", "priority")


@query("page_priority", CRAWL_PLAN_SQL + f"SELECT subreddit, sort_type, page_ix + 1 AS page, CAST({C.FIRST_PAGE_PRIORITY} - page_ix AS INTEGER) AS priority FROM plan")
def q_page_priority(spark, sf_dir):
    """Page index -> priority 10 - i."""
    return _crawl_plan(spark, sf_dir).select("subreddit", "sort_type", F.col("page").cast("bigint").alias("page"), "priority")


@query("crawl_size_estimate", W(V.POSTS_V_SQL) + f"""SELECT n * {len(C.SORT_TYPES) * C.PAGES_PER_SUBREDDIT} AS subreddit_pages,
  n * {len(C.SORT_TYPES) * C.PAGES_PER_SUBREDDIT * C.POSTS_PER_PAGE} AS estimated_posts,
  n * {len(C.SORT_TYPES) * C.PAGES_PER_SUBREDDIT * C.POSTS_PER_PAGE} AS estimated_comments,
  n * {len(C.SORT_TYPES) * C.PAGES_PER_SUBREDDIT * (1 + 2 * C.POSTS_PER_PAGE)} AS total_urls
FROM (SELECT count(DISTINCT subreddit) AS n FROM posts_v WHERE subreddit IS NOT NULL AND subreddit <> '')""")
def q_crawl_size_estimate(spark, sf_dir):
    """URLs a crawl of the subreddits seen asks for."""
    return FR.crawl_size_estimate(V.posts_v(spark, sf_dir).select("subreddit"))


@query("post_detail_jobs", W(V.POSTS_V_SQL) + f"""SELECT url, {C.POST_DETAIL_PRIORITY} AS priority, post_id, title FROM (
  SELECT {S.lit(C.SITE_BASE + '/r/')} || subreddit || '/comments/' || id || '.json' AS url, id AS post_id,
         substr(coalesce(title, ''), 1, 100) AS title FROM posts_v
  WHERE subreddit IS NOT NULL AND subreddit <> '' AND id IS NOT NULL AND id <> '')""")
def q_post_detail_jobs(spark, sf_dir):
    """Post-detail jobs from posts: URL, truncated title, priority 5."""
    jobs = FR.post_detail_jobs(V.posts_v(spark, sf_dir))
    meta = F.try_parse_json("metadata")
    return jobs.select("url", "priority", F.try_variant_get(meta, "$.post_id", "string").alias("post_id"),
                       F.try_variant_get(meta, "$.title", "string").alias("title"))


@query("run_summary", W(JV, V.POSTS_V_SQL) + """SELECT total, completed, failed,
  round(completed / greatest(total, 1) * 100, 2) AS success_rate,
  round((completed + failed) / greatest(total, 1) * 100, 2) AS progress_pct, output_files, output_rows, TRUE AS has_mb
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed') AS completed,
             count(*) FILTER (WHERE status = 'failed') AS failed FROM jobs_v),
     (SELECT CAST(count(DISTINCT subreddit) AS INTEGER) AS output_files, count(*) AS output_rows FROM posts_v)""")
def q_run_summary(spark, sf_dir):
    """One-row run summary (J13, D13, A16, D3): success rate from the job table, and the
    output of the run's posts: rows as observed in the write itself, files and MB
    from the file listing. The posts are written as one file a subreddit."""
    from ..session import scratch_path
    from ..sources import files as io
    path = scratch_path(spark, "summary_posts")
    rows = io.write_posts(V.posts_v(spark, sf_dir).repartition("subreddit"), path, fmt="parquet", partition_by="subreddit")
    out = FR.run_summary(FR.job_stats(V.jobs_v(spark, sf_dir)), io.file_inventory(spark, path), rows)
    return out.select("total", "completed", "failed", "success_rate", "progress_pct", F.col("output_files").cast("int").alias("output_files"),
                      "output_rows", (F.col("output_mb") > 0).alias("has_mb"))
