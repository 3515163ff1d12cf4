"""Scalar column functions: text cleaning, chunking, tokens, ids, URLs.

All functions build JVM-side Column expressions (no Python UDFs), so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (native ``btrim`` with the whitespace set; no regex scan)."""
    return F.btrim(_c(col), F.lit(C.STRIP_CHARS))


def clean_text(col) -> Column:
    """Falsy -> ''; drop NUL; CRLF -> LF; strip."""
    c = F.coalesce(_c(col).cast("string"), F.lit(""))
    c = F.replace(c, F.lit("\u0000"), F.lit(""))
    c = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    return strip(c)


def chunk_body(title, selftext) -> Column:
    """strip(title + '\\n' + selftext) with missing parts as '' (S9)."""
    return strip(F.concat(F.coalesce(_c(title), F.lit("")), F.lit("\n"), F.coalesce(_c(selftext), F.lit(""))))


def chunk_array(text, size: int, step: int) -> Column:
    """Overlapping fixed-size character windows.

    Every start offset ``0, step, 2*step, ... < length`` yields one chunk of up
    to ``size`` code points; a null or empty text yields an empty array.

    One walk over the text: each match moves on by ``step`` code points and
    looks ahead at ``size``, so the time is linear in the length (a substring by
    code point would start from the front again for every window).
    """
    window = F.lit(f"(?s)(?=(.{{1,{size}}})).{{1,{step}}}")
    return F.coalesce(F.regexp_extract_all(_c(text), window, F.lit(1)), F.array().cast("array<string>"))


def newline_to_space(col) -> Column:
    return F.replace(_c(col), F.lit("\n"), F.lit(" "))


def permalink(path, base: str = C.PERMALINK_BASE) -> Column:
    """Base URL + path; a missing path gives the bare base."""
    return F.concat(F.lit(base), F.coalesce(_c(path), F.lit("")))


def valid_subreddit(col) -> Column:
    return F.coalesce(_c(col).rlike(C.SUBREDDIT_NAME_PATTERN), F.lit(False))


def valid_post_id(col) -> Column:
    return F.coalesce(_c(col).rlike(C.POST_ID_PATTERN), F.lit(False))


def nonempty(col) -> Column:
    return _c(col).isNotNull() & (_c(col).cast("string") != "")


def tokens(col) -> Column:
    """Lower-cased maximal runs of letters/digits (empty pieces removed)."""
    return F.filter(F.split(F.lower(_c(col)), C.TOKEN_SPLIT), lambda x: x != "")


def hash_bucket(token: Column, dims: int = C.HASH_DIMS) -> Column:
    """Bucket of a token: first 7 hex digits of md5(token), mod ``dims``."""
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("bigint"), F.lit(dims)).cast("int")


def stable_id(*cols) -> Column:
    """Deterministic row id: sha256 over the parts joined by U+0001."""
    return F.sha2(F.concat_ws("\u0001", *[_c(c).cast("string") for c in cols]), 256)


def post_url(subreddit, post_id, base: str = C.SITE_BASE) -> Column:
    return F.concat(F.lit(f"{base}/r/"), _c(subreddit), F.lit("/comments/"), _c(post_id), F.lit(".json"))


def listing_url(subreddit, sort_type, after=None, base: str = C.SITE_BASE) -> Column:
    """Listing page URL; with an ``after`` token the page continues from it."""
    head = F.concat(F.lit(f"{base}/r/"), _c(subreddit), F.lit("/"), _c(sort_type), F.lit(".json"))
    if after is None:
        return F.concat(head, F.lit("?limit=100"))
    a = _c(after)
    return F.when(
        a.isNotNull() & (a != ""), F.concat(head, F.lit("?after="), a, F.lit("&limit=100"))
    ).otherwise(F.concat(head, F.lit("?limit=100")))


#: Largest magnitude that is safely a long.
_LONG = 9.2e18


def epoch_to_ts(col) -> Column:
    """Epoch seconds as a timestamp; NULL where they are no finite number in range."""
    micros = _c(col).try_cast("double") * F.lit(1_000_000)
    return F.when(F.abs(micros) < _LONG, F.timestamp_micros(micros.cast("bigint")))


def ts_text(col) -> Column:
    """Timestamp as fixed-width text (microseconds), for stable comparisons."""
    return F.date_format(_c(col), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def split_trim(col, sep: str = ",") -> Column:
    """'a, b ,c' -> ['a','b','c'] (elements stripped)."""
    return F.transform(F.split(_c(col), sep), lambda x: strip(x))


def coerce_long(col, default: int = 0) -> Column:
    """int(x) with a default: numeric text or numbers, truncated toward zero.
    Whole numbers keep all digits; inf, nan and values out of range give the default."""
    wide = _c(col).try_cast("double")
    cut = F.when(F.abs(wide) < _LONG, wide.cast("bigint"))
    return F.coalesce(_c(col).try_cast("bigint"), cut, F.lit(default).cast("bigint"))


def coerce_double(col, default: float = 0.0) -> Column:
    return F.coalesce(_c(col).try_cast("double"), F.lit(default))


def with_term_counts(df, tokens_col: str, out_col: str = "term_counts"):
    """Add ``out_col`` = array<struct<term, tf>>: the distinct tokens of
    ``tokens_col`` with their counts, computed inside the row (sort + run
    lengths) so term frequencies need no (doc, term) shuffle. Intermediate
    arrays are materialised as columns before the lambdas read them."""
    s = df.withColumn("_tc_sorted", F.array_sort(F.col(tokens_col)))
    n = F.size("_tc_sorted")
    starts = F.filter(F.sequence(F.lit(0), n - 1),
                      lambda i: (i == 0) | (F.get(F.col("_tc_sorted"), i) != F.get(F.col("_tc_sorted"), i - 1)))
    s = s.withColumn("_tc_starts", F.when(n > 0, starts).otherwise(F.array().cast("array<int>")))
    counts = F.transform(F.col("_tc_starts"), lambda st, k: F.struct(
        F.get(F.col("_tc_sorted"), st).alias("term"),
        (F.coalesce(F.get(F.col("_tc_starts"), k + 1), F.size("_tc_sorted")) - st).cast("long").alias("tf")))
    return s.withColumn(out_col, counts).drop("_tc_sorted", "_tc_starts")
