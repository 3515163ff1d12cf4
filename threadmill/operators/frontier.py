"""Crawl frontier as a table.

The job table is plain data: every "update" of the original queue is a
projection that returns the next version of the table, and every report is an
aggregate. ``as_of`` is always a parameter, all times are UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as tx


def _ts(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _minus_seconds(ts: Column, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) - F.lit(int(seconds) * 1_000_000))


# ---------------------------------------------------------------------------
# Discovery
# ---------------------------------------------------------------------------

def crawl_plan(subreddits: DataFrame, pages: int = C.PAGES_PER_SUBREDDIT, sort_types=C.SORT_TYPES,
               tokens: DataFrame | None = None) -> DataFrame:
    """Listing-page jobs: subreddits x sort types x pages.

    ``subreddits`` has a ``subreddit`` column. Page ``i`` (0-based) gets
    priority ``10 - i`` and JSON metadata. With ``tokens`` (subreddit,
    sort_type, page, after) from landed listings, page ``i > 0`` uses the
    token of page ``i - 1`` and a chain stops at the first page without one;
    without ``tokens`` all pages are planned and carry the page number only.
    """
    sorts = F.array(*[F.lit(s) for s in sort_types])
    base = subreddits.select(tx.strip(F.col("subreddit")).alias("subreddit")).where(tx.nonempty("subreddit"))
    plan = base.select("subreddit", F.explode(sorts).alias("sort_type"),
                       F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page_ix"))
    after = F.lit(None).cast("string")
    if tokens is not None:
        # The token landed with page p (1-based) opens page p + 1 (page_ix p).
        prev = tokens.select("subreddit", "sort_type", F.col("page").cast("int").alias("page_ix"), F.col("after").alias("_after"))
        plan = plan.join(prev, ["subreddit", "sort_type", "page_ix"], "left")
        after = F.col("_after")
        # pages of one chain (``pages`` rows at most) up to the first gap
        chain = Window.partitionBy("subreddit", "sort_type").orderBy("page_ix")
        gaps = F.count_if((F.col("page_ix") > 0) & after.isNull()).over(chain)
        plan = plan.withColumn("_gaps", gaps).where(F.col("_gaps") == 0)
    return plan.select(
        F.lit("subreddit_page").alias("job_type"),
        tx.listing_url(F.col("subreddit"), F.col("sort_type"), after).alias("url"),
        (F.lit(C.FIRST_PAGE_PRIORITY) - F.col("page_ix")).cast("int").alias("priority"),
        F.to_json(F.struct(F.col("subreddit"), F.col("sort_type"), (F.col("page_ix") + 1).alias("page"),
                           F.lit("discovery").alias("phase"))).alias("metadata"),
        "subreddit", "sort_type", (F.col("page_ix") + 1).alias("page"),
    )


def post_detail_jobs(posts: DataFrame, cap: int | None = None) -> DataFrame:
    """Post-detail jobs from posts with a subreddit and id.

    Duplicate URLs collapse to one (the highest score wins, then the smallest title,
    a missing one first). All jobs are returned; an explicit ``cap`` applies ``frontier_cap`` (F4).
    """
    p = posts.where(tx.nonempty("subreddit") & tx.nonempty("id"))
    jobs = p.select(
        tx.post_url(F.col("subreddit"), F.col("id")).alias("url"),
        F.col("subreddit"), F.col("id").alias("post_id"),
        F.substring(F.coalesce(F.col("title"), F.lit("")), 1, 100).alias("title"),
        F.coalesce(F.col("score"), F.lit(0)).alias("score"),
    )
    win = jobs.groupBy("url").agg(F.min_by(F.struct("subreddit", "post_id", "title", "score"),
                                           F.struct(-F.col("score").cast("double"), F.col("title"))).alias("j"))
    out = win.select(
        F.lit("post_detail").alias("job_type"), "url", F.lit(C.POST_DETAIL_PRIORITY).alias("priority"),
        F.to_json(F.struct(F.col("j.subreddit").alias("subreddit"), F.col("j.post_id").alias("post_id"),
                           F.col("j.title").alias("title"), F.col("j.score").alias("score"),
                           F.lit("post_detail").alias("phase"))).alias("metadata"),
    )
    return out if cap is None else frontier_cap(out, cap)


def frontier_cap(jobs: DataFrame, cap: int = C.MAX_DISCOVERY_URLS) -> DataFrame:
    """At most ``cap`` URLs, highest priority first, then URL.
    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``cap`` before anything is shuffled."""
    return jobs.orderBy(F.col("priority").desc(), F.col("url")).limit(cap)


def distinct_urls(jobs: DataFrame) -> DataFrame:
    """One row per URL; the first insert (smallest id) wins."""
    return jobs.groupBy("url").agg(F.min_by(F.struct(*[c for c in jobs.columns if c != "url"]), F.col("id")).alias("j")).select("url", "j.*")


def insert_new(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Insert-or-ignore (C5, J3): candidate URLs already in the frontier are
    ignored; among candidates with the same URL the first insert (smallest id)
    wins (S20). Returns only the rows really inserted."""
    fresh = candidates.join(existing.select("url"), "url", "left_anti")
    cols = [c for c in fresh.columns if c != "url"]
    return fresh.groupBy("url").agg(F.min_by(F.struct(*cols), "id").alias("j")).select("url", "j.*")


# ---------------------------------------------------------------------------
# Selection and transitions
# ---------------------------------------------------------------------------

def eligible(jobs: DataFrame, max_retries: int = C.MAX_RETRIES) -> Column:
    st = F.col("status")
    return (st == C.JOB_PENDING) | ((st == C.JOB_RETRY) & (F.col("retry_count") < max_retries))


def next_jobs(jobs: DataFrame, n: int, max_retries: int = C.MAX_RETRIES) -> DataFrame:
    """The next ``n`` eligible jobs: priority desc, created_at asc, id."""
    return (jobs.where(eligible(jobs, max_retries))
            .orderBy(F.col("priority").desc(), F.col("created_at").asc(), F.col("id").asc()).limit(n))


def claim(jobs: DataFrame, picked: DataFrame, worker_id: Column | str, as_of) -> DataFrame:
    """Mark picked jobs in progress (J5); ``picked`` has ``id`` (repeats count once)."""
    flag = picked.select(F.col("id").alias("_pid"), F.lit(True).alias("_picked")).distinct()
    j = jobs.join(flag, jobs["id"] == flag["_pid"], "left")
    hit = F.coalesce(F.col("_picked"), F.lit(False))
    wid = F.lit(worker_id) if isinstance(worker_id, str) else worker_id
    return j.select(
        *[F.when(hit, F.lit(C.JOB_IN_PROGRESS)).otherwise(F.col(c)).alias(c) if c == "status"
          else F.when(hit, wid).otherwise(F.col(c)).alias(c) if c == "worker_id"
          else F.when(hit, _ts(as_of)).otherwise(F.col(c)).alias(c) if c == "started_at"
          else F.col(c) for c in jobs.columns])


def _last_outcome(outcomes: DataFrame, *cols: str) -> DataFrame:
    """One outcome per id, the one that finished last (then the largest values)."""
    row = F.struct("finished_at", *(c for c in cols if c != "finished_at"))
    return outcomes.groupBy(F.col("id").alias("_oid")).agg(F.max(row).alias("_o"))


def apply_completions(jobs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Completed outcomes (``id``, ``finished_at``) -> status completed (J6); of
    several outcomes for an id the last one counts."""
    o = _last_outcome(outcomes).select("_oid", F.col("_o.finished_at").alias("_at"))
    j = jobs.join(o, jobs["id"] == o["_oid"], "left")
    hit = F.col("_oid").isNotNull()
    return j.select(*[F.when(hit, F.lit(C.JOB_COMPLETED)).otherwise(F.col(c)).alias(c) if c == "status"
                      else F.when(hit, F.col("_at")).otherwise(F.col(c)).alias(c) if c == "completed_at"
                      else F.col(c) for c in jobs.columns])


def apply_failures(jobs: DataFrame, outcomes: DataFrame, max_retries: int = C.MAX_RETRIES) -> DataFrame:
    """Failure outcomes (``id``, ``error``, ``finished_at``) -> retry with
    count + 1 while the incremented count stays below ``max_retries``,
    otherwise failed (J7, S22; exhausted retries end as failed, X2); of several
    outcomes for an id the last one counts."""
    o = _last_outcome(outcomes, "error").select("_oid", F.col("_o.error").alias("_err"), F.col("_o.finished_at").alias("_at"))
    j = jobs.join(o, jobs["id"] == o["_oid"], "left")
    hit = F.col("_oid").isNotNull()
    retry = hit & (F.col("retry_count") + 1 < max_retries)
    fail = hit & ~retry
    out = []
    for c in jobs.columns:
        if c == "status":
            out.append(F.when(retry, F.lit(C.JOB_RETRY)).when(fail, F.lit(C.JOB_FAILED)).otherwise(F.col(c)).alias(c))
        elif c == "retry_count":
            out.append(F.when(retry, F.col(c) + 1).otherwise(F.col(c)).alias(c))
        elif c == "worker_id":
            out.append(F.when(retry, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c))
        elif c == "error_message":
            out.append(F.when(hit, F.col("_err")).otherwise(F.col(c)).alias(c))
        elif c == "completed_at":
            out.append(F.when(fail, F.col("_at")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def reset_stalled(jobs: DataFrame, as_of, timeout_minutes: int = C.STALL_TIMEOUT_MINUTES,
                  max_retries: int = C.MAX_RETRIES) -> DataFrame:
    """In-progress jobs started before ``as_of - timeout`` go back to retry
    with one more retry counted and no worker (J8); a job whose count thereby
    reaches ``max_retries`` ends as failed instead of a retry that nothing may
    pick up (X2)."""
    stalled = (F.col("status") == C.JOB_IN_PROGRESS) & (F.col("started_at") < _minus_seconds(_ts(as_of), timeout_minutes * 60))
    stalled = F.coalesce(stalled, F.lit(False))
    next_status = F.when(F.col("retry_count") + 1 < max_retries, F.lit(C.JOB_RETRY)).otherwise(F.lit(C.JOB_FAILED))
    return jobs.select(*[F.when(stalled, next_status).otherwise(F.col(c)).alias(c) if c == "status"
                         else F.when(stalled, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c) if c == "worker_id"
                         else F.when(stalled, F.col(c) + 1).otherwise(F.col(c)).alias(c) if c == "retry_count"
                         else F.col(c) for c in jobs.columns])


def retention(jobs: DataFrame, as_of, days: int = C.CLEANUP_DAYS) -> DataFrame:
    """Drop completed/failed jobs finished before ``as_of - days``; rows with
    no ``completed_at`` are kept (J9)."""
    old = F.col("status").isin(C.JOB_COMPLETED, C.JOB_FAILED) & (F.col("completed_at") < _minus_seconds(_ts(as_of), days * 86400))
    return jobs.where(~F.coalesce(old, F.lit(False)))


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------

def _count_status(s: str) -> Column:
    return F.sum(F.when(F.col("status") == s, 1).otherwise(0)).cast("bigint")


def job_stats(jobs: DataFrame, as_of=None) -> DataFrame:
    """Queue report in one row (J10 = D4 + D5 + D6): counts per status (NULL
    sums on an empty table), mean duration of completed jobs in seconds,
    completions in the trailing minute (strict ``>``; 0 without ``as_of``)."""
    dur = (F.unix_micros(F.col("completed_at")) - F.unix_micros(F.col("started_at"))) / F.lit(1e6)
    done = (F.col("status") == C.JOB_COMPLETED) & F.col("completed_at").isNotNull() & F.col("started_at").isNotNull()
    recent = F.lit(False) if as_of is None else (
        (F.col("status") == C.JOB_COMPLETED) & (F.col("completed_at") > _minus_seconds(_ts(as_of), 60)))
    return jobs.agg(
        F.count(F.lit(1)).alias("total"),
        _count_status(C.JOB_PENDING).alias("pending"),
        _count_status(C.JOB_IN_PROGRESS).alias("in_progress"),
        _count_status(C.JOB_COMPLETED).alias("completed"),
        _count_status(C.JOB_FAILED).alias("failed"),
        _count_status(C.JOB_RETRY).alias("retry"),
        F.round(F.avg(F.when(done, dur)), 6).alias("avg_duration_seconds"),
        F.count_if(F.coalesce(recent, F.lit(False))).alias("jobs_per_minute"),
    )


def job_progress(stats: DataFrame) -> DataFrame:
    """Success rate and progress in percent, 2 decimals."""
    tot = F.greatest(F.col("total"), F.lit(1))
    return stats.select(
        "total", "completed", "failed",
        F.round(F.coalesce(F.col("completed"), F.lit(0)) / tot * 100, 2).alias("success_rate"),
        F.round((F.coalesce(F.col("completed"), F.lit(0)) + F.coalesce(F.col("failed"), F.lit(0))) / tot * 100, 2).alias("progress_pct"),
    )


def open_job_count(jobs: DataFrame) -> DataFrame:
    """Pending + retry jobs."""
    return jobs.agg(F.count_if(F.col("status").isin(C.JOB_PENDING, C.JOB_RETRY)).alias("open_jobs"))


def worker_stats(jobs: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Per worker: completed, failed, records, jobs per minute of active time."""
    j = jobs.where(F.col("worker_id").isNotNull())
    if results is not None:
        j = j.join(results.groupBy("job_id").agg(F.sum("record_count").alias("_rec")),
                   j["id"] == F.col("job_id"), "left").drop("job_id")
        rec = F.coalesce(F.col("_rec"), F.lit(0))
    else:
        rec = F.lit(0)
    agg = j.groupBy("worker_id").agg(
        F.count_if(F.col("status") == C.JOB_COMPLETED).alias("jobs_completed"),
        F.count_if(F.col("status") == C.JOB_FAILED).alias("jobs_failed"),
        F.sum(rec).cast("bigint").alias("total_records"),
        ((F.max(F.unix_micros("completed_at")) - F.min(F.unix_micros("started_at"))) / F.lit(1e6)).alias("_runtime"),
    )
    return agg.select("worker_id", "jobs_completed", "jobs_failed", "total_records",
                      F.round(F.col("jobs_completed") / F.greatest(F.coalesce(F.col("_runtime"), F.lit(0.0)), F.lit(1.0)) * 60, 2)
                      .alias("jobs_per_minute"))


def job_results(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Every job with its result rows (left join on the FK, C6)."""
    r = results.select(F.col("job_id"), F.col("data_path"), F.col("record_count"))
    return jobs.join(r, jobs["id"] == r["job_id"], "left").drop("job_id")


def current_state(attempts: DataFrame, key: str = "url", order: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """Latest attempt per job key (E5): ``max_by`` over a struct, partial
    aggregation per map task, so a hot key never gathers its history."""
    cols = [c for c in attempts.columns if c != key]
    return attempts.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_s"),
                                     F.count(F.lit(1)).alias("attempts")).select(key, "_s.*", "attempts")


def crawl_size_estimate(subreddits: DataFrame, pages: int = C.PAGES_PER_SUBREDDIT, sort_types=C.SORT_TYPES,
                        fetch_comments: bool = True) -> DataFrame:
    """URLs a crawl of the given subreddits asks for (J12): listing pages =
    subreddits x sort types x pages, posts = 100 per page, one comment job per
    post when comments are fetched."""
    n_subs = F.count_distinct(tx.strip(F.col("subreddit")))
    pages_col = n_subs * F.lit(len(sort_types) * pages)
    posts = pages_col * C.POSTS_PER_PAGE
    comments = posts if fetch_comments else F.lit(0)
    total = pages_col + posts + comments
    return subreddits.where(tx.nonempty("subreddit")).agg(
        pages_col.cast("bigint").alias("subreddit_pages"), posts.cast("bigint").alias("estimated_posts"),
        comments.cast("bigint").alias("estimated_comments"), total.cast("bigint").alias("total_urls"))


def run_summary(stats: DataFrame, files: DataFrame, rows: int | None = None) -> DataFrame:
    """One-row run summary (J13): success rate, output files, MB, and the ``rows`` that the
    write reported."""
    f = files.agg(F.count(F.lit(1)).alias("output_files"), F.round(F.sum("size_mb"), 2).alias("output_mb"),
                  F.lit(rows).cast("long").alias("output_rows"))
    one = F.lit(1).alias("_one")
    return job_progress(stats).select("*", one).join(f.select("*", one), "_one").drop("_one")
