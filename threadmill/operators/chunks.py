"""Posts -> chunk rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ChunkSpec
from ..functions import text as tx
from .layout import spread
from .posts import drop_deleted


def chunk_rows(
    df: DataFrame,
    text: Column,
    doc_id: Column,
    spec: ChunkSpec = ChunkSpec(),
    payload: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per chunk: ``chunk_id, doc_id, chunk_ix, chunk_text`` + payload.

    Chunking is a per-row ``posexplode`` of character windows: no shuffle,
    whole texts (every window of every text is emitted), time linear in the
    length of a text. ``chunk_id`` is a
    sha256 of (doc_id, chunk_ix, chunk_text), so re-indexing the same post
    yields the same ids and upserts stay idempotent.
    """
    payload = payload or {}
    df = spread(df)
    base = df.select(
        doc_id.cast("string").alias("doc_id"),
        tx.chunk_array(text, spec.size, spec.step).alias("_chunks"),
        *[c.alias(n) for n, c in payload.items()],
    )
    # posexplode_outer + null filter: a plain posexplode lets Catalyst infer
    # size(_chunks) > 0 and push it below the repartition into the scan task.
    out = base.select("doc_id", F.posexplode_outer("_chunks").alias("chunk_ix", "chunk_text"), *payload.keys())
    out = out.where(F.col("chunk_text").isNotNull())
    return out.select(
        tx.stable_id("doc_id", "chunk_ix", "chunk_text").alias("chunk_id"),
        "doc_id", F.col("chunk_ix").cast("int").alias("chunk_ix"), "chunk_text", *payload.keys(),
    )


def post_chunks(posts: DataFrame, spec: ChunkSpec = ChunkSpec(), id_col: str = "id") -> DataFrame:
    """Posts -> chunk rows with the retrieval payload.

    Body = strip(title + '\\n' + selftext); payload = permalink, subreddit,
    score (int, missing 0), created_utc (float, missing 0).
    """
    return chunk_rows(
        posts,
        tx.chunk_body("title", "selftext"),
        F.col(id_col),
        spec,
        {
            "permalink": F.coalesce(F.col("permalink"), F.lit("")),
            "subreddit": F.coalesce(F.col("subreddit"), F.lit("")),
            "score": tx.coerce_long(F.col("score")),
            "created_utc": tx.coerce_double(F.col("created_utc")),
        },
    )


def comment_chunks(comments: DataFrame, spec: ChunkSpec = ChunkSpec(), id_col: str = "id", body_col: str = "body") -> DataFrame:
    """Comments -> chunk rows, from an explicit body column (X5): cleaned bodies
    that are neither empty nor deleted; payload = post_id, score, created_utc."""
    return chunk_rows(
        drop_deleted(comments, body_col),
        tx.clean_text(F.col(body_col)),
        F.col(id_col),
        spec,
        {
            "post_id": F.col("post_id"),
            "score": tx.coerce_long(F.col("score")),
            "created_utc": tx.coerce_double(F.col("created_utc")),
        },
    )
