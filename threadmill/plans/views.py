"""Stand-in views: the driver tables re-read as forum data.

Each view has a Spark builder and the equivalent DuckDB SQL (used by the
oracle). The mappings are deliberately simple, deterministic column
expressions, so both engines produce identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import table_path

# Fixed evaluation instant for recency filters: 2024-01-31T00:00:00Z.
AS_OF_EPOCH = 1706659200
AS_OF_TEXT = "2024-01-31 00:00:00"
EPOCH0 = 1704067200  # 2024-01-01T00:00:00Z


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# ---------------------------------------------------------------------------
# posts_v: documents as posts
# ---------------------------------------------------------------------------

def posts_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    nl = F.instr(F.col("text"), "\n")
    has_nl = nl > 0
    pid = F.concat(F.lit("p"), F.col("doc_id").cast("string"))
    return d.select(
        F.col("doc_id"),
        pid.alias("id"),
        F.when(has_nl, F.substring_index(F.col("text"), "\n", 1)).alias("title"),
        F.when(has_nl, F.expr("substr(text, instr(text, '\n') + 1)")).otherwise(F.col("text")).alias("selftext"),
        F.col("source").alias("subreddit"),
        F.col("lang").alias("flair"),
        (F.col("n_chars") % 50).alias("score"),
        (F.col("doc_id") % 7).alias("num_comments"),
        (F.lit(EPOCH0) + (F.col("doc_id") * 2592) % 2592000).cast("double").alias("created_utc"),
        F.concat(F.lit("/r/"), F.col("source"), F.lit("/comments/"), pid, F.lit("/")).alias("permalink_path"),
        F.when(F.col("doc_id") % 13 != 0, F.concat(F.lit("u"), (F.col("doc_id") % 97).cast("string"))).alias("author"),
        (F.col("doc_id") % 11 == 0).alias("over_18"),
        F.col("n_chars"),
    )


POSTS_V_SQL = f"""
posts_v AS (
  SELECT doc_id,
         'p' || CAST(doc_id AS VARCHAR) AS id,
         CASE WHEN strpos(text, chr(10)) > 0 THEN split_part(text, chr(10), 1) END AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE text END AS selftext,
         source AS subreddit,
         lang AS flair,
         n_chars % 50 AS score,
         doc_id % 7 AS num_comments,
         CAST({EPOCH0} + (doc_id * 2592) % 2592000 AS DOUBLE) AS created_utc,
         '/r/' || source || '/comments/' || 'p' || CAST(doc_id AS VARCHAR) || '/' AS permalink_path,
         CASE WHEN doc_id % 13 <> 0 THEN 'u' || CAST(doc_id % 97 AS VARCHAR) END AS author,
         (doc_id % 11 = 0) AS over_18,
         n_chars
  FROM documents
)"""


# ---------------------------------------------------------------------------
# comments_v: conversations as comment trees (adjacency rows)
# ---------------------------------------------------------------------------

def comments_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    cid = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit("_"), t.cast("string"))
    return c.select(
        F.concat(F.lit("p"), F.col("conv_id").cast("string")).alias("post_id"),
        cid(F.col("turn")).alias("id"),
        F.when(F.col("turn") > 0, cid(F.floor((F.col("turn") - 1) / 2))).alias("parent_id"),
        F.col("turn"),
        F.col("role").alias("author"),
        F.when(F.col("turn") % 5 == 3, F.lit(C.DELETED_BODIES[0])).otherwise(F.col("text")).alias("body"),
        (F.length(F.col("text")) % 20).cast("bigint").alias("score"),
        (F.lit(EPOCH0) + F.col("conv_id") * 3600 + F.col("turn") * 60).cast("double").alias("created_utc"),
    )


COMMENTS_V_SQL = f"""
comments_v AS (
  SELECT 'p' || CAST(conv_id AS VARCHAR) AS post_id,
         CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id,
         CASE WHEN turn > 0 THEN CAST(conv_id AS VARCHAR) || '_' || CAST(CAST(floor((turn - 1) / 2) AS BIGINT) AS VARCHAR) END AS parent_id,
         turn,
         role AS author,
         CASE WHEN turn % 5 = 3 THEN '[deleted]' ELSE text END AS body,
         CAST(length(text) % 20 AS BIGINT) AS score,
         CAST({EPOCH0} + conv_id * 3600 + turn * 60 AS DOUBLE) AS created_utc
  FROM conversations
)"""


# ---------------------------------------------------------------------------
# jobs_v: events as a crawl job table
# ---------------------------------------------------------------------------

def jobs_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    status = (F.when(F.col("event_type") == "click", "pending")
              .when(F.col("event_type") == "view", "in_progress")
              .when(F.col("event_type") == "purchase", "completed")
              .when(F.col("event_type") == "error", "failed")
              .otherwise("retry"))
    started = F.when(status != "pending", F.timestamp_micros(F.unix_micros(ts) + 1_000_000))
    completed = F.when(status.isin("completed", "failed"),
                       F.timestamp_micros(F.unix_micros(ts) + 1_000_000
                                          + (F.floor(F.col("value")).cast("bigint") + 1) * 1_000_000))
    jtype = (F.when(F.col("event_id") % 3 == 0, "subreddit_page")
             .when(F.col("event_id") % 3 == 1, "post_detail").otherwise("comment_thread"))
    return e.select(
        F.col("event_id").alias("id"),
        jtype.alias("job_type"),
        F.concat(F.lit("https://x/"), (F.col("event_id") % 7000).cast("string")).alias("url"),
        status.alias("status"),
        (F.col("event_id") % 10).cast("int").alias("priority"),
        (F.col("user_id") % 5).cast("int").alias("retry_count"),
        F.when(status != "pending", F.concat(F.lit("w"), (F.col("user_id") % 8).cast("string"))).alias("worker_id"),
        ts.alias("created_at"),
        started.alias("started_at"),
        completed.alias("completed_at"),
        F.when(status.isin("failed", "retry"), F.concat(F.lit("error "), F.col("user_id").cast("string"))).alias("error_message"),
        F.col("props").alias("metadata"),
    )


JOBS_V_SQL = """
jobs_v AS (
  SELECT event_id AS id,
         CASE event_id % 3 WHEN 0 THEN 'subreddit_page' WHEN 1 THEN 'post_detail' ELSE 'comment_thread' END AS job_type,
         'https://x/' || CAST(event_id % 7000 AS VARCHAR) AS url,
         status,
         CAST(event_id % 10 AS INTEGER) AS priority,
         CAST(user_id % 5 AS INTEGER) AS retry_count,
         CASE WHEN status <> 'pending' THEN 'w' || CAST(user_id % 8 AS VARCHAR) END AS worker_id,
         ts AS created_at,
         CASE WHEN status <> 'pending' THEN make_timestamp(epoch_us(ts) + 1000000) END AS started_at,
         CASE WHEN status IN ('completed', 'failed')
              THEN make_timestamp(epoch_us(ts) + 1000000 + (CAST(floor(value) AS BIGINT) + 1) * 1000000) END AS completed_at,
         CASE WHEN status IN ('failed', 'retry') THEN 'error ' || CAST(user_id AS VARCHAR) END AS error_message,
         props AS metadata
  FROM (SELECT *, CASE event_type WHEN 'click' THEN 'pending' WHEN 'view' THEN 'in_progress'
                      WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'retry' END AS status
        FROM events) e
)"""


# ---------------------------------------------------------------------------
# polls_v: events as repeated polls of posts
# ---------------------------------------------------------------------------

def polls_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("id"),
        F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("title"),
        F.floor(F.col("value")).cast("bigint").alias("score"),
        (F.col("event_id") % 17).alias("num_comments"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("created_utc"),
        F.col("event_type").alias("subreddit"),
        F.col("ts").cast("timestamp").alias("scraped_at"),
        F.col("event_id"),
    )


POLLS_V_SQL = """
polls_v AS (
  SELECT 'p' || CAST(user_id AS VARCHAR) AS id,
         't' || CAST(event_id AS VARCHAR) AS title,
         CAST(floor(value) AS BIGINT) AS score,
         event_id % 17 AS num_comments,
         epoch_us(ts) / 1000000 AS created_utc,
         event_type AS subreddit,
         ts AS scraped_at,
         event_id
  FROM events
)"""


# ---------------------------------------------------------------------------
# vectors_v: embeddings as chunk vectors with a payload
# ---------------------------------------------------------------------------

def vectors_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read(spark, sf_dir, "embeddings")
    return v.select(
        F.col("vec_id"),
        F.col("embedding"),
        F.col("label"),
        F.col("label").cast("string").alias("subreddit"),
        (F.col("vec_id") % 100).alias("score"),
    )


VECTORS_V_SQL = """
vectors_v AS (
  SELECT vec_id, embedding, label, CAST(label AS VARCHAR) AS subreddit, vec_id % 100 AS score
  FROM embeddings
)"""


# ---------------------------------------------------------------------------
# queries_v: benchmark items as retrieval queries
# ---------------------------------------------------------------------------

def queries_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


QUERIES_V_SQL = """
queries_v AS (SELECT item_id AS query_id, text AS query_text FROM benchmark)"""


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# ---------------------------------------------------------------------------
# results_v: one result row per completed job (FK job_id -> jobs_v.id)
# ---------------------------------------------------------------------------

def results_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").alias("id"), F.col("event_id").alias("job_id"),
        F.concat(F.lit("out/w"), (F.col("user_id") % 8).cast("string"), F.lit(".parquet")).alias("data_path"),
        F.floor(F.col("value")).cast("bigint").alias("record_count"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


RESULTS_V_SQL = """
results_v AS (
  SELECT event_id AS id, event_id AS job_id, 'out/w' || CAST(user_id % 8 AS VARCHAR) || '.parquet' AS data_path,
         CAST(floor(value) AS BIGINT) AS record_count, ts AS created_at
  FROM events WHERE event_type = 'purchase'
)"""
