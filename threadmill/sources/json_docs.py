"""Landed JSON documents -> fixed-schema rows.

Raw bodies (one JSON document per row, e.g. from ``spark.read.text(...,
wholetext=True)``) are parsed once into VARIANT with ``try_parse_json``; bodies
that are not JSON go to a quarantine table instead of failing the job.
Listings are unwrapped with ``posexplode`` over ``data.children``; every
output column comes from the field tables in :mod:`threadmill.schemas`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as tx


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def vget(v: Column, key: str) -> Column:
    """Child ``key`` of a VARIANT object as VARIANT; SQL NULL when missing."""
    return F.try_variant_get(v, _path(key), "variant")


def has_key(v: Column, key: str) -> Column:
    return vget(v, key).isNotNull()


def field(v: Column, key: str, typ: str, default=None) -> Column:
    """Field with dict.get semantics (S1): default only when the key is missing,
    an explicit JSON null stays null, wrong types become null."""
    raw = vget(v, key)
    lit_default = F.lit(default)
    if typ == "clean":
        val = tx.clean_text(F.try_variant_get(raw, "$", "string"))
        return F.when(raw.isNull(), F.lit(str(default or ""))).otherwise(val)
    if typ == "json":
        val = F.to_json(raw)
        return F.when(raw.isNull() | F.is_variant_null(raw), F.lit(None).cast("string")).otherwise(val)
    if typ == "permalink":
        path = F.when(raw.isNull() | F.is_variant_null(raw), F.lit("")).otherwise(
            F.try_variant_get(raw, "$", "string"))
        return tx.permalink(path)
    val = F.try_variant_get(raw, "$", typ)
    return F.when(raw.isNull(), lit_default.cast(typ)).when(F.is_variant_null(raw), F.lit(None).cast(typ)).otherwise(val)


def edited_fields(v: Column) -> list[Column]:
    """``edited`` is false, true or an epoch number upstream: split it."""
    raw = vget(v, "edited")
    kind = F.schema_of_variant(raw)
    is_bool = kind == F.lit("BOOLEAN")
    edited = (
        F.when(raw.isNull(), F.lit(False))
        .when(F.is_variant_null(raw), F.lit(None).cast("boolean"))
        .when(is_bool, F.try_variant_get(raw, "$", "boolean"))
        .otherwise(F.lit(True))
    )
    edited_utc = F.when(raw.isNotNull() & ~F.is_variant_null(raw) & ~is_bool,
                        F.try_variant_get(raw, "$", "double"))
    return [edited.alias("edited"), edited_utc.alias("edited_utc")]


def extract(v: Column, fields) -> list[Column]:
    cols = []
    for name, key, typ, default in fields:
        if typ == "edited":
            cols.extend(edited_fields(v))
        else:
            cols.append(field(v, key, typ, default).alias(name))
    return cols


def raw_fields(v: Column, spec: list[tuple[str, str]]) -> list[Column]:
    """Raw projection (B4/B5): ``(name, type)`` pairs read as they are, with
    no defaults and no cleaning; missing keys and JSON nulls are NULL."""
    return [F.try_variant_get(v, _path(name), typ).alias(name) for name, typ in spec]


QUICK_FIELDS = [("id", "string"), ("title", "string"), ("selftext", "string"), ("url", "string"),
                ("score", "bigint"), ("num_comments", "bigint"), ("created_utc", "double"),
                ("author", "string"), ("subreddit", "string"), ("permalink", "string")]


def required_present(v: Column, keys=schemas.REQUIRED_POST_KEYS) -> Column:
    """Required keys must be present; their values may be null (S3)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & has_key(v, k)
    return cond


def parse_bodies(raw: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``doc`` (VARIANT); unparsable bodies get ``doc`` = NULL."""
    return raw.withColumn("doc", F.try_parse_json(F.col(body_col)))


def quarantine(raw: DataFrame, body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """Split raw bodies into (parsed, rejected) without failing the job."""
    parsed = parse_bodies(raw, body_col)
    good = parsed.where(F.col("doc").isNotNull())
    bad = parsed.where(F.col("doc").isNull()).drop("doc").withColumn("reason", F.lit("invalid_json"))
    return good, bad


def listing_children(parsed: DataFrame, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per child of a listing: (keep..., pos, kind, data VARIANT, after)."""
    d = F.col(doc)
    children = F.try_variant_get(d, "$.data.children", "array<variant>")
    return (
        parsed.select(*keep, F.try_variant_get(d, "$.data.after", "string").alias("after"),
                      F.posexplode(children).alias("pos", "child"))
        .select(*keep, "after", "pos",
                F.try_variant_get("child", "$.kind", "string").alias("kind"),
                F.coalesce(F.try_variant_get("child", "$.data", "variant"),
                           F.parse_json(F.lit("{}"))).alias("data"))
    )


def posts_from_listings(parsed: DataFrame, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """Listing documents -> validated post rows.

    Only ``kind = 't3'`` children whose required keys are present are kept.
    Recency and score filters are separate operators so that post-detail
    documents can skip them.
    """
    ch = listing_children(parsed, doc, keep)
    d = F.col("data")
    return ch.where((F.col("kind") == "t3") & required_present(d)).select(*keep, *extract(d, schemas.POST_FIELDS))


def next_page_tokens(parsed: DataFrame, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """``data.after`` of listings that have children and a token."""
    d = F.col(doc)
    n_children = F.size(F.coalesce(F.try_variant_get(d, "$.data.children", "array<variant>"),
                                   F.array().cast("array<variant>")))
    after = F.try_variant_get(d, "$.data.after", "string")
    return parsed.where((n_children > 0) & after.isNotNull() & (after != "")).select(*keep, after.alias("after"))


def post_detail(parsed: DataFrame, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """Post-detail documents (array of listings, element 0 = post) -> post row
    tagged ``detail_fetch = true``; no recency/score filter (A13)."""
    d = F.col(doc)
    first = F.try_variant_get(d, "$[0].data.children[0].data", "variant")
    return (
        parsed.select(*keep, first.alias("data"))
        .where(F.col("data").isNotNull() & required_present(F.col("data")))
        .select(*keep, *extract(F.col("data"), schemas.POST_FIELDS), F.lit(True).alias("detail_fetch"))
    )


def thread_roots(parsed: DataFrame, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """Thread documents (2-element array) -> top-level comment nodes.

    Output: keep..., post VARIANT (element 0's post data or NULL), pos, kind,
    data VARIANT. Documents shorter than 2 elements give nothing (A12).
    """
    d = F.col(doc)
    arr = F.try_variant_get(d, "$", "array<variant>")
    top = F.try_variant_get(d, "$[1].data.children", "array<variant>")
    post = F.try_variant_get(d, "$[0].data.children[0]", "variant")
    post_data = F.when(F.try_variant_get(post, "$.kind", "string") == "t3", F.try_variant_get(post, "$.data", "variant"))
    return (
        parsed.where(F.size(arr) >= 2)
        .select(*keep, post_data.alias("post"), F.posexplode(F.coalesce(top, F.array().cast("array<variant>"))).alias("pos", "child"))
        .select(*keep, "post", "pos",
                F.try_variant_get("child", "$.kind", "string").alias("kind"),
                F.coalesce(F.try_variant_get("child", "$.data", "variant"), F.parse_json(F.lit("{}"))).alias("data"))
    )
