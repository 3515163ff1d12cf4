"""Registered queries: sources, sinks, post filters, scalar functions (A, B, G)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from ..functions import text as tx
from ..operators import posts as P
from ..session import scratch_path
from ..sources import files as io
from ..sources import json_docs as jd
from . import sqlkit as S
from . import views as V
from .registry import query

W = V.with_views
PV = V.POSTS_V_SQL
AS_OF = V.AS_OF_EPOCH
RECENT_FROM = AS_OF - C.INGEST_DAYS * 86400


# ---------------------------------------------------------------------------
# Landed listing documents built from posts_v (the Spark side writes JSON text
# and parses it back; the oracle reads posts_v directly).
# ---------------------------------------------------------------------------

def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON listing document per (subreddit, page): at most 100 children
    (page = doc_id div 100 + 1); ``after`` = last child's fullname, NULL on a
    subreddit's last page. Columns: subreddit, page, body."""
    p = V.posts_v(spark, sf_dir)
    data = F.to_json(F.struct(
        F.col("id"), F.col("title"), F.col("selftext"), F.col("score"), F.col("num_comments"),
        F.col("created_utc"), F.col("subreddit"), F.col("permalink_path").alias("permalink"),
        F.col("flair").alias("link_flair_text"), F.col("over_18")))
    author = F.to_json(F.struct(F.col("author")), {"ignoreNullFields": "false"})
    merged = F.concat(F.expr("substr(_a, 1, length(_a) - 1)"), F.lit(","), F.expr("substr(_d, 2)"))
    child = F.concat(F.lit('{"kind":"t3","data":'), merged, F.lit("}"))
    kids = (p.select("subreddit", (F.floor(F.col("doc_id") / 100) + 1).alias("page"), F.col("doc_id"),
                     author.alias("_a"), data.alias("_d"))
            .select("subreddit", "page", "doc_id", child.alias("child")))
    pages = kids.groupBy("subreddit", "page").agg(
        F.array_join(F.collect_list("child"), ",").alias("children"), F.max("doc_id").alias("last_doc"))
    last = pages.groupBy("subreddit").agg(F.max("page").alias("_last_page"))
    pages = pages.join(last, "subreddit")
    after = F.when(F.col("page") < F.col("_last_page"), F.concat(F.lit('"t3_p'), F.col("last_doc").cast("string"), F.lit('"'))).otherwise(F.lit("null"))
    body = F.concat(F.lit('{"kind":"Listing","data":{"after":'), after, F.lit(',"children":['), F.col("children"), F.lit("]}}"))
    return pages.select("subreddit", "page", body.alias("body"))


def parsed_listing_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = jd.parse_bodies(listing_pages(spark, sf_dir))
    return jd.posts_from_listings(docs, keep=("page",))


PAGES_SQL = """
pages_v AS (
  SELECT subreddit, page, last_doc,
         CASE WHEN page < max(page) OVER (PARTITION BY subreddit) THEN 't3_p' || CAST(last_doc AS VARCHAR) END AS after
  FROM (SELECT subreddit, CAST(floor(doc_id / 100) AS BIGINT) + 1 AS page, max(doc_id) AS last_doc
        FROM posts_v GROUP BY 1, 2) g
)"""


def _post_field_sql(name: str, key: str, typ: str, default) -> list[str]:
    """Oracle expression for one extracted post field; keys present in the
    built listing come from posts_v, the rest are missing -> default."""
    present = {
        "id": "id", "title": "title", "selftext": "selftext", "score": "score", "num_comments": "num_comments",
        "created_utc": "created_utc", "subreddit": "subreddit", "permalink": "permalink_path",
        "link_flair_text": "flair", "over_18": "over_18", "author": "author",
    }
    sql_t = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "json": "VARCHAR"}
    if typ == "edited":
        return ["FALSE AS edited", "CAST(NULL AS DOUBLE) AS edited_utc"]
    src = present.get(key)
    if typ == "clean":
        return [f"{S.clean(src) if src else S.lit(default or '')} AS {name}"]
    if typ == "permalink":
        return [f"{S.lit(C.PERMALINK_BASE)} || coalesce({src}, '') AS {name}" if src else f"{S.lit(C.PERMALINK_BASE)} AS {name}"]
    if src:
        return [f"CAST({src} AS {sql_t[typ]}) AS {name}"]
    if default is None:
        return [f"CAST(NULL AS {sql_t[typ]}) AS {name}"]
    val = S.lit(default) if isinstance(default, str) else ("TRUE" if default is True else "FALSE" if default is False else repr(default))
    return [f"CAST({val} AS {sql_t[typ]}) AS {name}"]


EXTRACT_COLS_SQL = ",\n       ".join(c for f in schemas.POST_FIELDS for c in _post_field_sql(*f))


# ---------------------------------------------------------------------------
# A: scans and sinks
# ---------------------------------------------------------------------------

@query("scan_parquet", W(PV) + "SELECT * FROM posts_v")
def q_scan_parquet(spark, sf_dir):
    """Documents read with the schema of their file and projected as posts (A1)."""
    return V.posts_v(spark, sf_dir)


def _with_ingest_date(df: DataFrame) -> DataFrame:
    return df.withColumn("ingest_date", F.date_format(tx.epoch_to_ts("created_utc"), "yyyy-MM-dd"))


INGEST_DATE_SQL = "strftime(make_timestamp(CAST(created_utc * 1000000 AS BIGINT)), '%Y-%m-%d')"


@query("sink_parquet_roundtrip", W(PV) + f"SELECT *, {INGEST_DATE_SQL} AS ingest_date FROM posts_v")
def q_sink_parquet(spark, sf_dir):
    """Write posts partitioned by ingest date, read them back."""
    df = _with_ingest_date(V.posts_v(spark, sf_dir))
    path = scratch_path(spark, "posts_parquet")
    io.write_posts(df, path, fmt="parquet")
    return io.read_posts(spark, path, df.schema, fmt="parquet")


@query("sink_jsonl_roundtrip", W(PV) + f"SELECT *, {INGEST_DATE_SQL} AS ingest_date FROM posts_v")
def q_sink_jsonl(spark, sf_dir):
    """Write posts as JSON lines (nulls kept, UTF-8 unescaped), read back."""
    df = _with_ingest_date(V.posts_v(spark, sf_dir))
    path = scratch_path(spark, "posts_jsonl")
    io.write_posts(df, path, fmt="JSONL")
    return io.read_posts(spark, path, df.schema, fmt="jsonl")


@query("partition_pruned_scan", W(PV) + f"SELECT id, subreddit, ingest_date FROM (SELECT *, {INGEST_DATE_SQL} AS ingest_date FROM posts_v) "
       "WHERE ingest_date BETWEEN '2024-01-10' AND '2024-01-12'")
def q_partition_pruned(spark, sf_dir):
    """Date-directory layout read through a partition filter."""
    df = _with_ingest_date(V.posts_v(spark, sf_dir))
    path = scratch_path(spark, "posts_by_date")
    io.write_posts(df, path, fmt="parquet")
    back = io.read_posts(spark, path, df.schema, fmt="parquet")
    return back.where(F.col("ingest_date").between("2024-01-10", "2024-01-12")).select("id", "subreddit", "ingest_date")


@query("recent_partitions", W(PV) + f"""SELECT ingest_date, count(*) AS n_posts
FROM (SELECT *, {INGEST_DATE_SQL} AS ingest_date FROM posts_v)
WHERE ingest_date >= '2024-01-25' AND ingest_date <= '2024-01-31'
  AND ingest_date IN (SELECT DISTINCT {INGEST_DATE_SQL} AS d FROM posts_v
                      WHERE {INGEST_DATE_SQL} BETWEEN '2024-01-25' AND '2024-01-31' ORDER BY d DESC LIMIT 10)
GROUP BY 1""")
def q_recent_partitions(spark, sf_dir):
    """Last 7 days of date partitions relative to ``as_of``, newest first, at most the 10 newest."""
    df = _with_ingest_date(V.posts_v(spark, sf_dir))
    path = scratch_path(spark, "posts_recent")
    io.write_posts(df, path, fmt="parquet")
    back = io.read_posts(spark, path, df.schema, fmt="parquet")
    return io.recent_partitions(back, "2024-01-31", days=7, newest=10).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n_posts")).orderBy(F.col("ingest_date").desc())


@query("latest_batch", W(PV) + f"""SELECT id, batch_id FROM (SELECT id, 'b' || {INGEST_DATE_SQL} AS batch_id FROM posts_v)
WHERE batch_id = (SELECT max('b' || {INGEST_DATE_SQL}) FROM posts_v)""")
def q_latest_batch(spark, sf_dir):
    """Rows of the newest batch only."""
    df = P.tag_provenance(V.posts_v(spark, sf_dir), batch_id=F.concat(F.lit("b"), F.date_format(tx.epoch_to_ts("created_utc"), "yyyy-MM-dd")))
    return io.latest_batch(df, "batch_id").select("id", "batch_id")


@query("parse_listing", W(PV, PAGES_SQL) + f"""SELECT id, {S.clean('title')} AS title, author, subreddit, CAST(floor(doc_id / 100) AS BIGINT) + 1 AS page
FROM posts_v WHERE title IS NOT NULL""")
def q_parse_listing(spark, sf_dir):
    """Listing JSON -> children of kind t3 with their fields."""
    return parsed_listing_posts(spark, sf_dir).select("id", "title", "author", "subreddit", F.col("page").cast("bigint").alias("page"))


@query("extract_posts", W(PV) + f"SELECT {EXTRACT_COLS_SQL}\nFROM posts_v WHERE title IS NOT NULL")
def q_extract_posts(spark, sf_dir):
    """All post fields with defaults, renames and the edited split."""
    return parsed_listing_posts(spark, sf_dir).drop("page")


@query("next_page_urls", W(PV, PAGES_SQL) + f"""SELECT subreddit, page,
  {S.lit(C.SITE_BASE + '/r/')} || subreddit || '/new.json?after=' || after || '&limit=100' AS url
FROM pages_v WHERE after IS NOT NULL""")
def q_next_page_urls(spark, sf_dir):
    """Pagination tokens of landed listings -> next page URLs."""
    docs = jd.parse_bodies(listing_pages(spark, sf_dir))
    tok = jd.next_page_tokens(docs, keep=("subreddit", "page"))
    return tok.select("subreddit", F.col("page").cast("bigint").alias("page"),
                      tx.listing_url(F.col("subreddit"), F.lit("new"), F.col("after")).alias("url"))


@query("quarantine", """SELECT 'pages' AS src, page_id AS key, CASE WHEN json_valid(html) THEN 'ok' ELSE 'invalid_json' END AS status FROM pages
UNION ALL SELECT 'events', event_id, CASE WHEN json_valid(props) THEN 'ok' ELSE 'invalid_json' END FROM events""")
def q_quarantine(spark, sf_dir):
    """Raw bodies split into parsed and quarantined rows, no failure."""
    raw = (V.read(spark, sf_dir, "pages").select(F.lit("pages").alias("src"), F.col("page_id").alias("key"), F.col("html").alias("body"))
           .unionByName(V.read(spark, sf_dir, "events").select(F.lit("events").alias("src"), F.col("event_id").alias("key"), F.col("props").alias("body"))))
    good, bad = jd.quarantine(raw)
    return good.select("src", "key", F.lit("ok").alias("status")).unionByName(bad.select("src", "key", F.col("reason").alias("status")))


# ---------------------------------------------------------------------------
# B: filters and projections
# ---------------------------------------------------------------------------

@query("valid_posts", W(PV) + "SELECT id, subreddit FROM posts_v WHERE title IS NOT NULL")
def q_valid_posts(spark, sf_dir):
    """Posts whose required keys are present (B6, S3): docs without a title line lack the key."""
    return parsed_listing_posts(spark, sf_dir).select("id", "subreddit")


@query("recent_filter", W(PV) + f"SELECT id, created_utc FROM posts_v WHERE created_utc >= {RECENT_FROM}")
def q_recent(spark, sf_dir):
    """created >= as_of - 7 days, inclusive."""
    return P.recent(V.posts_v(spark, sf_dir), AS_OF).select("id", "created_utc")


@query("score_filter", W(PV) + f"SELECT id, score FROM posts_v WHERE coalesce(score, 0) >= {C.MIN_SCORE}")
def q_score(spark, sf_dir):
    """score >= min_score, missing = 0."""
    return P.min_score(V.posts_v(spark, sf_dir)).select("id", "score")


@query("ingest_filters", W(PV) + f"""SELECT id FROM posts_v WHERE title IS NOT NULL
AND created_utc >= {RECENT_FROM} AND coalesce(score, 0) >= {C.MIN_SCORE}""")
def q_ingest_filters(spark, sf_dir):
    """Listing -> valid -> recent -> score floor: the whole post ingest filter."""
    return P.passes_filters(parsed_listing_posts(spark, sf_dir), AS_OF).select("id")


@query("total_records", W(PV) + f"""SELECT count(*) AS total_records FROM posts_v WHERE title IS NOT NULL
AND created_utc >= {RECENT_FROM} AND coalesce(score, 0) >= {C.MIN_SCORE}""")
def q_total_records(spark, sf_dir):
    """Count of posts collected by one ingest (D3)."""
    return P.passes_filters(parsed_listing_posts(spark, sf_dir), AS_OF).agg(F.count(F.lit(1)).alias("total_records"))


@query("poll_projection", W(V.POLLS_V_SQL) + f"""SELECT id, title, score, num_comments, created_utc, subreddit,
  {S.ts('scraped_at')} AS scraped_at FROM polls_v""")
def q_poll_projection(spark, sf_dir):
    """Poll rows: six post fields plus scraped_at."""
    p = V.polls_v(spark, sf_dir)
    return p.select("id", "title", "score", "num_comments", "created_utc", "subreddit", tx.ts_text("scraped_at").alias("scraped_at"))


@query("quick_projection", W(PV) + """SELECT id, title, selftext, CAST(NULL AS VARCHAR) AS url, score, num_comments, created_utc,
  author, subreddit, permalink_path AS permalink FROM posts_v""")
def q_quick_projection(spark, sf_dir):
    """Quick scrape: 10 raw fields of every listing child, no defaults,
    cleaning or filters (B5)."""
    docs = jd.parse_bodies(listing_pages(spark, sf_dir))
    return jd.listing_children(docs).select(*jd.raw_fields(F.col("data"), jd.QUICK_FIELDS))


@query("drop_deleted", W(V.COMMENTS_V_SQL) + "SELECT id, post_id FROM comments_v WHERE body IS NOT NULL AND body <> '' AND body NOT IN ('[deleted]', '[removed]')")
def q_drop_deleted(spark, sf_dir):
    """Drop empty/[deleted]/[removed] bodies."""
    return P.drop_deleted(V.comments_v(spark, sf_dir)).select("id", "post_id")


@query("has_comments", W(PV) + "SELECT id, num_comments FROM posts_v WHERE coalesce(num_comments, 0) > 0")
def q_has_comments(spark, sf_dir):
    """Posts worth a comment fetch."""
    return P.with_comments(V.posts_v(spark, sf_dir)).select("id", "num_comments")


@query("nonempty_keys", W(PV) + "SELECT id, author FROM posts_v WHERE id IS NOT NULL AND id <> '' AND author IS NOT NULL AND author <> ''")
def q_nonempty_keys(spark, sf_dir):
    """Rows with non-null, non-empty keys."""
    return P.nonempty_keys(V.posts_v(spark, sf_dir), "id", "author").select("id", "author")


@query("valid_subreddit", W(PV) + """SELECT name, regexp_full_match(name, '[a-zA-Z0-9_]{3,21}') AS valid
FROM (SELECT DISTINCT subreddit AS name FROM posts_v UNION SELECT DISTINCT flair FROM posts_v UNION SELECT DISTINCT author FROM posts_v WHERE author IS NOT NULL)""")
def q_valid_subreddit(spark, sf_dir):
    """Subreddit-name validity on every name-like value."""
    p = V.posts_v(spark, sf_dir)
    names = (p.select(F.col("subreddit").alias("name")).union(p.select("flair")).union(p.select("author").where(F.col("author").isNotNull()))).distinct()
    return names.select("name", tx.valid_subreddit("name").alias("valid"))


@query("valid_post_id", W(PV) + "SELECT id, regexp_full_match(id, '[a-z0-9]{3,10}') AS valid FROM posts_v")
def q_valid_post_id(spark, sf_dir):
    """Post-id validity."""
    return V.posts_v(spark, sf_dir).select("id", tx.valid_post_id("id").alias("valid"))


@query("payload_filter", W(V.VECTORS_V_SQL) + "SELECT vec_id FROM vectors_v WHERE score >= 10 AND subreddit = '3'")
def q_payload_filter(spark, sf_dir):
    """Filter dict -> one predicate, pushed into the scan."""
    return V.vectors_v(spark, sf_dir).where(P.payload_filter({"subreddit": "3", "min_score": 10})).select("vec_id")


@query("exclude_nsfw", W(PV) + "SELECT id FROM posts_v WHERE NOT coalesce(over_18, FALSE)")
def q_exclude_nsfw(spark, sf_dir):
    """Optional NSFW exclusion."""
    return P.exclude_nsfw(V.posts_v(spark, sf_dir)).select("id")


@query("split_trim_list", W(PV) + f"""SELECT doc_id, pos - 1 AS pos, {S.strip('item')} AS item
FROM (SELECT doc_id, unnest(string_split(title, ',')) AS item, generate_subscripts(string_split(title, ','), 1) AS pos
      FROM posts_v WHERE title IS NOT NULL)""")
def q_split_trim(spark, sf_dir):
    """Comma list -> stripped elements."""
    p = V.posts_v(spark, sf_dir).where(F.col("title").isNotNull())
    return p.select("doc_id", F.posexplode(tx.split_trim("title")).alias("pos", "item")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "item")


@query("route_by_type", W(V.JOBS_V_SQL) + """SELECT id,
  CASE WHEN jt IN ('subreddit_page', 'post_detail', 'comment_thread') THEN jt ELSE 'failed' END AS route,
  CASE WHEN jt NOT IN ('subreddit_page', 'post_detail', 'comment_thread') THEN 'Unknown job type: ' || jt END AS route_error
FROM (SELECT id, CASE WHEN id % 11 = 0 THEN 'legacy_' || job_type ELSE job_type END AS jt FROM jobs_v)""")
def q_route(spark, sf_dir):
    """Rows routed by job type; unknown types become failures."""
    j = V.jobs_v(spark, sf_dir)
    j = j.withColumn("job_type", F.when(F.col("id") % 11 == 0, F.concat(F.lit("legacy_"), F.col("job_type"))).otherwise(F.col("job_type")))
    return P.route_by_type(j).select("id", "route", "route_error")


@query("posts_per_subreddit", W(PV) + "SELECT coalesce(subreddit, 'unknown') AS subreddit, count(*) AS n_posts FROM posts_v GROUP BY 1")
def q_posts_per_subreddit(spark, sf_dir):
    """Posts per subreddit, sorted."""
    return P.posts_per_subreddit(V.posts_v(spark, sf_dir))


@query("union_sources", W(PV) + """SELECT id, 'listing' AS via FROM posts_v WHERE title IS NOT NULL
UNION ALL SELECT id, 'quick' FROM posts_v""")
def q_union_sources(spark, sf_dir):
    """Bag union of per-source results (G-U1)."""
    a = parsed_listing_posts(spark, sf_dir).select("id", F.lit("listing").alias("via"))
    b = V.posts_v(spark, sf_dir).select("id", F.lit("quick").alias("via"))
    return a.unionByName(b)


# ---------------------------------------------------------------------------
# G: scalar functions
# ---------------------------------------------------------------------------

@query("clean_text", "SELECT doc_id, md5(" + S.clean("text") + ") AS text_md5, length(" + S.clean("text") + ") AS n FROM documents")
def q_clean_text(spark, sf_dir):
    """clean_text over whole documents."""
    d = V.read(spark, sf_dir, "documents")
    c = tx.clean_text("text")
    return d.select("doc_id", F.md5(c).alias("text_md5"), F.length(c).cast("bigint").alias("n"))


@query("permalink", W(PV) + f"SELECT id, {S.lit(C.PERMALINK_BASE)} || coalesce(permalink_path, '') AS permalink FROM posts_v")
def q_permalink(spark, sf_dir):
    """Base URL + path."""
    return V.posts_v(spark, sf_dir).select("id", tx.permalink("permalink_path").alias("permalink"))


@query("chunk_body", W(PV) + f"SELECT id, md5({S.strip("coalesce(title, '') || chr(10) || coalesce(selftext, '')")}) AS body_md5 FROM posts_v")
def q_chunk_body(spark, sf_dir):
    """strip(title + '\\n' + selftext)."""
    return V.posts_v(spark, sf_dir).select("id", F.md5(tx.chunk_body("title", "selftext")).alias("body_md5"))


@query("chunk_text", f"""SELECT doc_id, CAST(i / {C.ChunkSpec().step} AS INTEGER) AS chunk_ix, md5(substr(text, i + 1, {C.ChunkSpec().size})) AS chunk_md5,
  length(substr(text, i + 1, {C.ChunkSpec().size})) AS n
FROM documents, unnest(range(0, length(text), {C.ChunkSpec().step})) AS u(i)""")
def q_chunk_text(spark, sf_dir):
    """Overlapping character windows of whole documents."""
    spec = C.ChunkSpec()
    d = V.read(spark, sf_dir, "documents")
    ch = d.select("doc_id", F.posexplode(tx.chunk_array("text", spec.size, spec.step)).alias("chunk_ix", "c"))
    return ch.select("doc_id", F.col("chunk_ix").cast("int").alias("chunk_ix"), F.md5("c").alias("chunk_md5"), F.length("c").cast("bigint").alias("n"))


@query("epoch_to_ts", W(PV) + f"SELECT id, {S.ts('make_timestamp(CAST(created_utc * 1000000 AS BIGINT))')} AS created_at FROM posts_v")
def q_epoch_to_ts(spark, sf_dir):
    """Epoch seconds -> UTC timestamp."""
    return V.posts_v(spark, sf_dir).select("id", tx.ts_text(tx.epoch_to_ts("created_utc")).alias("created_at"))


@query("ingest_date", W(PV) + """SELECT id, strftime(make_timestamp(CAST(created_utc * 1000000 AS BIGINT)), '%Y-%m-%d') AS ingest_date,
  strftime(make_timestamp(CAST(created_utc * 1000000 AS BIGINT)), '%H%M%S') AS ingest_time FROM posts_v""")
def q_ingest_date(spark, sf_dir):
    """Date and time-of-day strings."""
    ts = tx.epoch_to_ts("created_utc")
    return V.posts_v(spark, sf_dir).select("id", F.date_format(ts, "yyyy-MM-dd").alias("ingest_date"), F.date_format(ts, "HHmmss").alias("ingest_time"))


@query("post_urls", W(PV) + f"SELECT id, {S.lit(C.SITE_BASE + '/r/')} || subreddit || '/comments/' || id || '.json' AS url FROM posts_v")
def q_post_urls(spark, sf_dir):
    """Post detail URL."""
    return V.posts_v(spark, sf_dir).select("id", tx.post_url("subreddit", "id").alias("url"))


@query("listing_urls", W(PV) + f"""SELECT DISTINCT subreddit, s.sort_type,
  {S.lit(C.SITE_BASE + '/r/')} || subreddit || '/' || s.sort_type || '.json?limit=100' AS url
FROM posts_v, (SELECT unnest(['new', 'hot', 'top']) AS sort_type) s""")
def q_listing_urls(spark, sf_dir):
    """First listing page URL per subreddit and sort."""
    subs = V.posts_v(spark, sf_dir).select("subreddit").distinct()
    return subs.select("subreddit", F.explode(F.array(*[F.lit(s) for s in C.SORT_TYPES])).alias("sort_type")).select(
        "subreddit", "sort_type", tx.listing_url("subreddit", "sort_type").alias("url"))


@query("metadata_json", W(V.JOBS_V_SQL) + """SELECT id, CAST(json_extract(metadata, '$.k') AS BIGINT) AS k,
  '{"job_id":' || CAST(id AS VARCHAR) || ',"k":' || CAST(CAST(json_extract(metadata, '$.k') AS BIGINT) AS VARCHAR) || '}' AS meta_out FROM jobs_v""")
def q_metadata_json(spark, sf_dir):
    """JSON metadata decode and encode."""
    j = V.jobs_v(spark, sf_dir)
    k = F.try_variant_get(F.try_parse_json("metadata"), "$.k", "bigint")
    return j.select("id", k.alias("k"), F.to_json(F.struct(F.col("id").alias("job_id"), k.alias("k"))).alias("meta_out"))


@query("coerce_numeric", """SELECT event_id, coalesce(CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT), 0) AS k_int,
  coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k_float,
  coalesce(CAST(trunc(TRY_CAST(event_type AS DOUBLE)) AS BIGINT), 0) AS type_int FROM events""")
def q_coerce_numeric(spark, sf_dir):
    """int()/float() coercion with defaults."""
    e = V.read(spark, sf_dir, "events")
    kstr = F.get_json_object("props", "$.k")
    return e.select("event_id", tx.coerce_long(kstr).alias("k_int"),
                    tx.coerce_double(kstr).alias("k_float"), tx.coerce_long("event_type").alias("type_int"))


@query("latest_per_post", W(V.POLLS_V_SQL) + f"""SELECT id, arg_max(event_id, (scraped_at, event_id)) AS event_id,
  arg_max(score, (scraped_at, event_id)) AS score, {S.ts('max(scraped_at)')} AS scraped_at FROM polls_v GROUP BY 1""")
def q_latest_per_post(spark, sf_dir):
    """Latest poll row per post across polls (E3): max_by over a struct,
    partially aggregated per map task (a hot post never gathers its history)."""
    p = V.polls_v(spark, sf_dir).select("id", "event_id", "score", "scraped_at")
    latest = P.latest_per_key(p, "id", "scraped_at", tie="event_id")
    return latest.select("id", "event_id", "score", tx.ts_text("scraped_at").alias("scraped_at"))


@query("sink_by_subreddit", W(PV) + """SELECT 'all' AS output, subreddit, id FROM posts_v
UNION ALL SELECT 'own', subreddit, id FROM posts_v WHERE subreddit IS NOT NULL""")
def q_sink_by_subreddit(spark, sf_dir):
    """Per-subreddit output plus the combined view (A15): one write partitioned by
    subreddit. ``all`` is the combined read; ``own`` reads the folder of each
    subreddit by itself."""
    df = V.posts_v(spark, sf_dir)
    path = scratch_path(spark, "posts_by_subreddit")
    io.write_posts(df, path, fmt="parquet", partition_by="subreddit")
    out = io.read_posts(spark, path, df.schema, fmt="parquet").select(F.lit("all").alias("output"), "subreddit", "id")
    for r in df.select("subreddit").distinct().where("subreddit is not null").orderBy("subreddit").collect():  # the sources, few
        own = io.read_posts(spark, path, df.schema, fmt="parquet").where(F.col("subreddit") == r.subreddit)
        out = out.unionByName(own.select(F.lit("own").alias("output"), "subreddit", "id"))
    return out


@query("newest_file", W(PV) + "SELECT id, title FROM posts_v WHERE doc_id % 3 = 1")
def q_newest_file(spark, sf_dir):
    """Rows of the landing written last, of three that many tasks write."""
    df = V.posts_v(spark, sf_dir)
    path = scratch_path(spark, "landings")
    for part in (0, 2, 1):
        io.write_posts(df.where(F.col("doc_id") % 3 == part), f"{path}/landing={part}", partition_by=None)
    return io.newest_file(io.read_posts(spark, path, df.schema), folders=True).select("id", "title")


@query("sink_comments", W(V.COMMENTS_V_SQL) + "SELECT id, post_id, parent_id, author, body, score, created_utc FROM comments_v")
def q_sink_comments(spark, sf_dir):
    """Comments written and read back whole, as JSON lines (A5)."""
    df = V.comments_v(spark, sf_dir)
    path = scratch_path(spark, "comments")
    io.write_posts(df, path, fmt="jsonl", partition_by=None)
    return io.read_posts(spark, path, df.schema, fmt="jsonl").select("id", "post_id", "parent_id", "author", "body", "score", "created_utc")


@query("sink_split_files", W(PV) + """SELECT CAST(ceil(count(*) / 100) AS BIGINT) AS n_files, count(*) AS n_rows,
  CAST(least(count(*), 100) AS BIGINT) AS largest FROM posts_v""")
def q_sink_split_files(spark, sf_dir):
    """A batch cut into files of at most 100 rows (K8): files and rows from file metadata."""
    path = scratch_path(spark, "split_files")
    io.write_posts(io.full_files(V.posts_v(spark, sf_dir), 100), path, partition_by=None, max_records_per_file=100)
    files = io.file_rows(spark.read.parquet(path))
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"), F.max("n_rows").alias("largest"))


@query("summary_json", W(PV) + "SELECT count(*) AS posts, count(DISTINCT subreddit) AS subreddits, CAST(sum(score) AS BIGINT) AS score, CAST(NULL AS DOUBLE) AS speedup FROM posts_v")
def q_summary_json(spark, sf_dir):
    """A run summary written as one JSON document and read back (A18); missing values stay null."""
    p = V.posts_v(spark, sf_dir)
    path = scratch_path(spark, "summary_json")
    one = p.agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("subreddit").alias("subreddits"), F.sum("score").cast("bigint").alias("score"),
                F.lit(None).cast("double").alias("speedup"))
    io.write_summary_json(one, path)
    return spark.read.schema(one.schema).json(path)


def detail_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed post-detail document per post (a 2-element array: the post
    listing and an empty comment listing), built row by row."""
    p = V.posts_v(spark, sf_dir)
    data = F.to_json(F.struct(
        F.col("id"), F.col("title"), F.col("selftext"), F.col("score"), F.col("num_comments"),
        F.col("created_utc"), F.col("subreddit"), F.col("permalink_path").alias("permalink"),
        F.col("flair").alias("link_flair_text"), F.col("over_18")))
    body = F.concat(F.lit('[{"kind":"Listing","data":{"children":[{"kind":"t3","data":'), data,
                    F.lit('}]}},{"kind":"Listing","data":{"children":[]}}]'))
    return p.select(body.alias("body"))


@query("post_detail", W(PV) + f"SELECT id, {S.clean('title')} AS title, score, created_utc, TRUE AS detail_fetch FROM posts_v WHERE title IS NOT NULL")
def q_post_detail(spark, sf_dir):
    """Post-detail documents -> validated post rows tagged detail_fetch, with
    no recency or score filter (A13, A12 element 0)."""
    docs = jd.parse_bodies(detail_documents(spark, sf_dir))
    return jd.post_detail(docs).select("id", "title", "score", "created_utc", "detail_fetch")


@query("scan_jsonl", W(PV) + "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt FROM posts_v")
def q_scan_jsonl(spark, sf_dir):
    """JSON-lines posts read with a fixed schema in PERMISSIVE mode: a bad
    line becomes a quarantine value instead of aborting the read (A2, B19)."""
    df = V.posts_v(spark, sf_dir)
    path = scratch_path(spark, "posts_scan_jsonl")
    io.write_posts(df, path, fmt="jsonl", partition_by=None)
    return io.read_posts(spark, path, df.schema, fmt="jsonl", quarantine_col="_corrupt")
