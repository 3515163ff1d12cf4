"""Job-table transitions and reports (FIXTURES §4)."""

import datetime as dt

from pyspark.sql import functions as F

from threadmill import schemas
from threadmill.operators import frontier as FR

T0 = dt.datetime(2024, 1, 31, 12, 0, 0)


def jobs(spark, rows):
    full = []
    for r in rows:
        d = dict(id=None, job_type="post_detail", url=None, status="pending", priority=0, retry_count=0, worker_id=None,
                 created_at=T0, started_at=None, completed_at=None, error_message=None, metadata=None)
        d.update(r)
        full.append(tuple(d[f.name] for f in schemas.JOBS.fields))
    return spark.createDataFrame(full, schemas.JOBS)


def test_insert_or_ignore(spark):
    existing = jobs(spark, [dict(id=1, url="u1")])
    cand = jobs(spark, [dict(id=2, url="u1"), dict(id=3, url="u2", priority=1), dict(id=4, url="u2", priority=5)])
    got = FR.insert_new(existing, cand).collect()
    assert [(r["url"], r["id"]) for r in got] == [("u2", 3)]  # first insert wins (S20)


def test_pick_order_and_eligibility(spark):
    j = jobs(spark, [dict(id=1, url="a", priority=1), dict(id=2, url="b", priority=5),
                     dict(id=3, url="c", priority=5, created_at=T0 - dt.timedelta(seconds=1)),
                     dict(id=4, url="d", priority=9, status="retry", retry_count=3),
                     dict(id=5, url="e", priority=9, status="retry", retry_count=2)])
    assert [r["id"] for r in FR.next_jobs(j, 10).collect()] == [5, 3, 2, 1]


def test_failure_transitions(spark):
    j = jobs(spark, [dict(id=1, url="a", status="in_progress", retry_count=0, worker_id="w"),
                     dict(id=2, url="b", status="in_progress", retry_count=2, worker_id="w")])
    out = FR.apply_failures(j, spark.createDataFrame([(1, "boom", T0), (2, "boom", T0)], "id long, error string, finished_at timestamp"))
    r = {x["id"]: x for x in out.collect()}
    assert (r[1]["status"], r[1]["retry_count"], r[1]["worker_id"]) == ("retry", 1, None)
    assert (r[2]["status"], r[2]["completed_at"]) == ("failed", T0)
    assert out.count() == 2  # transitions conserve rows


def test_stalled_and_retention(spark):
    j = jobs(spark, [dict(id=1, url="a", status="in_progress", started_at=T0 - dt.timedelta(minutes=31)),
                     dict(id=2, url="b", status="in_progress", started_at=T0 - dt.timedelta(minutes=29)),
                     dict(id=3, url="c", status="completed", completed_at=T0 - dt.timedelta(days=8)),
                     dict(id=4, url="d", status="failed", completed_at=None)])
    as_of = F.lit(T0).cast("timestamp")
    r = {x["id"]: x for x in FR.reset_stalled(j, as_of).collect()}
    assert (r[1]["status"], r[1]["retry_count"]) == ("retry", 1) and r[2]["status"] == "in_progress"
    assert sorted(x["id"] for x in FR.retention(j, as_of, 7).collect()) == [1, 2, 4]


def test_stats_empty_and_strict_minute(spark):
    empty = jobs(spark, []).limit(0)
    s = FR.job_stats(empty, F.lit(T0)).first()
    assert s["total"] == 0 and s["pending"] is None
    assert FR.job_progress(FR.job_stats(empty, F.lit(T0))).first()["progress_pct"] == 0.0
    j = jobs(spark, [dict(id=1, url="a", status="completed", started_at=T0 - dt.timedelta(seconds=90), completed_at=T0 - dt.timedelta(seconds=60)),
                     dict(id=2, url="b", status="completed", started_at=T0 - dt.timedelta(seconds=90), completed_at=T0 - dt.timedelta(seconds=59))])
    s = FR.job_stats(j, F.lit(T0)).first()
    assert s["jobs_per_minute"] == 1 and s["avg_duration_seconds"] == 30.5


def test_crawl_plan_chain_stops(spark):
    subs = spark.createDataFrame([(" s1 ",), ("",)], "subreddit string")
    toks = spark.createDataFrame([("s1", "new", 1, "t3_a"), ("s1", "new", 2, "t3_b")], "subreddit string, sort_type string, page int, after string")
    plan = FR.crawl_plan(subs, pages=5, tokens=toks).collect()
    got = sorted((r["sort_type"], r["page"], r["priority"]) for r in plan)
    assert got == [("hot", 1, 10), ("new", 1, 10), ("new", 2, 9), ("new", 3, 8), ("top", 1, 10)]
    est = FR.crawl_size_estimate(subs, pages=5).first()
    assert (est["subreddit_pages"], est["total_urls"]) == (15, 15 * 201)


def test_crawl_plan_without_tokens_and_with_a_gap(spark):
    subs = spark.createDataFrame([("s1",)], "subreddit string")
    plan = FR.crawl_plan(subs, pages=5).collect()
    assert len(plan) == 15 and all("after=" not in r["url"] for r in plan)
    toks = spark.createDataFrame([("s1", "new", 1, "a"), ("s1", "new", 3, "c")], "subreddit string, sort_type string, page int, after string")
    got = [r["page"] for r in FR.crawl_plan(subs, pages=5, tokens=toks).where("sort_type = 'new'").orderBy("page").collect()]
    assert got == [1, 2]  # page 3 needs the token of page 2


def test_post_detail_jobs_has_no_default_cap(spark):
    posts = spark.range(100_500).selectExpr("'s' as subreddit", "cast(id as string) as id", "'t' as title", "1 as score")
    assert FR.post_detail_jobs(posts).count() == 100_500
    assert FR.post_detail_jobs(posts, cap=10).count() == 10


def test_first_insert_wins(spark):
    empty = jobs(spark, [dict(id=0, url="z")])
    cand = jobs(spark, [dict(id=1, url="u", priority=1), dict(id=2, url="u", priority=9)])
    assert [r["id"] for r in FR.insert_new(empty, cand).collect()] == [1]


def test_exhausted_stall_fails(spark):
    j = jobs(spark, [dict(id=1, url="a", status="in_progress", retry_count=2, started_at=T0 - dt.timedelta(hours=2)),
                     dict(id=2, url="b", status="in_progress", retry_count=0, started_at=T0 - dt.timedelta(hours=2))])
    got = {r["id"]: (r["status"], r["retry_count"]) for r in FR.reset_stalled(j, F.lit(T0)).collect()}
    assert got == {1: ("failed", 3), 2: ("retry", 1)}


def test_one_outcome_per_job(spark):
    j = jobs(spark, [dict(id=1, url="a", status="in_progress", retry_count=0)])
    late, early = T0, T0 - dt.timedelta(seconds=5)
    done = spark.createDataFrame([(1, early), (1, late)], "id long, finished_at timestamp")
    assert [r["completed_at"] for r in FR.apply_completions(j, done).collect()] == [late]
    bad = spark.createDataFrame([(1, early, "x"), (1, late, "y")], "id long, finished_at timestamp, error string")
    assert [(r["error_message"], r["retry_count"]) for r in FR.apply_failures(j, bad).collect()] == [("y", 1)]
    assert FR.claim(j, j.select("id").union(j.select("id")), "w", F.lit(T0)).count() == 1
