"""Fixed output schemas (never inferred) and the field tables that drive the
JSON extraction.

A field spec is ``(output_name, json_key, spark_type, default)``. ``default``
applies only when the key is *missing*; an explicit JSON null stays null.
Special types: ``clean`` (text, cleaned), ``json`` (nested value kept as JSON
text), ``permalink`` (base URL + path), ``edited`` (bool-or-epoch union split
into ``edited``/``edited_utc``).
"""

from __future__ import annotations

from pyspark.sql import types as T

from . import config as C

POST_FIELDS: list[tuple[str, str, str, object]] = [
    ("id", "id", "string", None),
    ("title", "title", "clean", ""),
    ("author", "author", "string", C.DELETED_AUTHOR),
    ("selftext", "selftext", "clean", ""),
    ("score", "score", "bigint", 0),
    ("ups", "ups", "bigint", 0),
    ("downs", "downs", "bigint", 0),
    ("num_comments", "num_comments", "bigint", 0),
    ("created_utc", "created_utc", "double", 0.0),
    ("subreddit", "subreddit", "string", None),
    ("permalink", "permalink", "permalink", ""),
    ("url", "url", "string", ""),
    ("is_self", "is_self", "boolean", False),
    ("over_18", "over_18", "boolean", False),
    ("stickied", "stickied", "boolean", False),
    ("flair", "link_flair_text", "string", None),
    ("upvote_ratio", "upvote_ratio", "double", None),
    ("thumbnail", "thumbnail", "string", None),
    ("domain", "domain", "string", None),
    ("gilded", "gilded", "bigint", 0),
    ("total_awards_received", "total_awards_received", "bigint", 0),
    ("is_video", "is_video", "boolean", False),
    ("locked", "locked", "boolean", False),
    ("spoiler", "spoiler", "boolean", False),
    ("hidden", "hidden", "boolean", False),
    ("archived", "archived", "boolean", False),
    ("media", "media", "json", None),
    ("media_embed", "media_embed", "json", None),
    ("preview", "preview", "json", None),
    ("distinguished", "distinguished", "string", None),
    ("edited", "edited", "edited", False),
    ("subreddit_name_prefixed", "subreddit_name_prefixed", "string", None),
    ("subreddit_type", "subreddit_type", "string", None),
    ("subreddit_id", "subreddit_id", "string", None),
    ("author_fullname", "author_fullname", "string", None),
    ("view_count", "view_count", "bigint", None),
    ("visited", "visited", "boolean", False),
    ("saved", "saved", "boolean", False),
    ("clicked", "clicked", "boolean", False),
]

COMMENT_FIELDS: list[tuple[str, str, str, object]] = [
    ("id", "id", "string", None),
    ("author", "author", "string", C.DELETED_AUTHOR),
    ("body", "body", "clean", ""),
    ("score", "score", "bigint", 0),
    ("ups", "ups", "bigint", 0),
    ("downs", "downs", "bigint", 0),
    ("created_utc", "created_utc", "double", 0.0),
    ("parent_id", "parent_id", "string", None),
    ("link_id", "link_id", "string", None),
    ("subreddit", "subreddit", "string", None),
    ("permalink", "permalink", "permalink", ""),
    ("gilded", "gilded", "bigint", 0),
    ("total_awards_received", "total_awards_received", "bigint", 0),
    ("distinguished", "distinguished", "string", None),
    ("edited", "edited", "edited", False),
    ("stickied", "stickied", "boolean", False),
    ("is_submitter", "is_submitter", "boolean", False),
    ("score_hidden", "score_hidden", "boolean", False),
    ("archived", "archived", "boolean", False),
    ("author_fullname", "author_fullname", "string", None),
    ("subreddit_id", "subreddit_id", "string", None),
    ("controversiality", "controversiality", "bigint", 0),
    ("depth", "depth", "bigint", 0),
]

REQUIRED_POST_KEYS = ("id", "title", "created_utc", "subreddit")

_SPARK = {
    "string": T.StringType(),
    "clean": T.StringType(),
    "json": T.StringType(),
    "permalink": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _struct(fields) -> T.StructType:
    out = []
    for name, _key, typ, _default in fields:
        if typ == "edited":
            out.append(T.StructField("edited", T.BooleanType()))
            out.append(T.StructField("edited_utc", T.DoubleType()))
        else:
            out.append(T.StructField(name, _SPARK[typ]))
    return T.StructType(out)


POSTS = _struct(POST_FIELDS)
COMMENTS = _struct(COMMENT_FIELDS)

COMMENTS_SLIM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("discovered_by", T.StringType()),
    ]
)

CHUNKS = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("chunk_ix", T.IntegerType()),
        T.StructField("chunk_text", T.StringType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("created_utc", T.DoubleType()),
    ]
)

JOBS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("job_type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("worker_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("metadata", T.StringType()),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("data_path", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

POLLS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)
