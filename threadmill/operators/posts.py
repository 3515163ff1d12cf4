"""Post filters, provenance and per-subreddit reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as tx


def recent(df: DataFrame, as_of_epoch: float, days: int = C.INGEST_DAYS, col: str = "created_utc") -> DataFrame:
    """Keep rows created at or after ``as_of - days`` (inclusive, S4).

    ``as_of`` is a parameter (never the wall clock) so results are repeatable;
    comparing the raw epoch column keeps the predicate pushable to Parquet.
    """
    return df.where(F.col(col) >= F.lit(float(as_of_epoch - days * 86400)))


def min_score(df: DataFrame, floor: int = C.MIN_SCORE, col: str = "score") -> DataFrame:
    """Drop only ``score < floor``; a missing score counts as 0."""
    return df.where(F.coalesce(F.col(col), F.lit(0)) >= F.lit(floor))


def passes_filters(df: DataFrame, as_of_epoch: float, days: int = C.INGEST_DAYS, floor: int = C.MIN_SCORE) -> DataFrame:
    return min_score(recent(df, as_of_epoch, days), floor)


def exclude_nsfw(df: DataFrame, col: str = "over_18") -> DataFrame:
    return df.where(~F.coalesce(F.col(col), F.lit(False)))


def with_comments(df: DataFrame) -> DataFrame:
    """Posts worth a comment fetch (``num_comments > 0``, B11)."""
    return df.where(F.coalesce(F.col("num_comments"), F.lit(0)) > 0)


def nonempty_keys(df: DataFrame, *cols: str) -> DataFrame:
    """Rows whose key columns are all non-null and non-empty."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & tx.nonempty(c)
    return df.where(cond)


def drop_deleted(df: DataFrame, col: str = "body") -> DataFrame:
    """Drop empty, '[deleted]' and '[removed]' bodies."""
    b = F.col(col)
    return df.where(b.isNotNull() & (b != "") & ~b.isin(*C.DELETED_BODIES))


def payload_filter(filters: dict | None) -> Column:
    """Fold a filter dict into one predicate (S15): ``min_score`` means
    ``score >= v``; every other key means equality. Empty -> TRUE."""
    cond = F.lit(True)
    for key, val in (filters or {}).items():
        if key == "min_score":
            cond = cond & (F.col("score") >= F.lit(val))
        else:
            cond = cond & (F.col(key) == F.lit(val))
    return cond


def tag_provenance(df: DataFrame, discovered_by: str | None = None, batch_id: str | Column | None = None,
                   detail_fetch: bool | None = None) -> DataFrame:
    """Attach worker/batch provenance (B17); all values are parameters."""
    out = df
    if discovered_by is not None:
        out = out.withColumn("discovered_by", F.lit(discovered_by))
    if batch_id is not None:
        out = out.withColumn("batch_id", batch_id if isinstance(batch_id, Column) else F.lit(batch_id))
    if detail_fetch is not None:
        out = out.withColumn("detail_fetch", F.lit(detail_fetch))
    return out


def route_by_type(jobs: DataFrame, known=C.JOB_TYPES) -> DataFrame:
    """Route rows by ``job_type``: known types get a handler name, unknown
    ones a failure message (B20)."""
    jt = F.col("job_type")
    return jobs.withColumn(
        "route", F.when(jt.isin(*known), jt).otherwise(F.lit("failed"))
    ).withColumn(
        "route_error", F.when(~jt.isin(*known) | jt.isNull(), F.concat(F.lit("Unknown job type: "), F.coalesce(jt, F.lit("None"))))
    )


def posts_per_subreddit(df: DataFrame) -> DataFrame:
    """Posts per subreddit, missing names as 'unknown', by name."""
    return (df.groupBy(F.coalesce(F.col("subreddit"), F.lit("unknown")).alias("subreddit"))
            .agg(F.count(F.lit(1)).alias("n_posts"))
            .orderBy("subreddit"))


def latest_per_key(df: DataFrame, key: str = "id", order_col: str = "scraped_at", tie: str | None = None) -> DataFrame:
    """Latest row per key across polls/re-ingests.

    ``max_by`` over a struct runs as a partial + final aggregate (a sort
    aggregate, since struct buffers are not hash-aggregate compatible): a hot
    key is reduced to one row inside each map task before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    order = F.struct(F.col(order_col), F.col(tie)) if tie else F.col(order_col)
    return df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_r")).select(key, "_r.*")
