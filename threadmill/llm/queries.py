"""Registered queries of the llm operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm.bpe import encode_documents
from threadmill.llm.common import prepare
from threadmill.llm.hard_negatives import labelled_vectors, mine_negatives
from threadmill.llm.language_id import identify
from threadmill.llm.lexical_search import search
from threadmill.llm.line_dedup import dedup_lines
from threadmill.llm.minhash_dedup import near_duplicates
from threadmill.llm.mixing import allocate, sized
from threadmill.llm.quality_rules import judge_quality
from threadmill.llm.secret_scan import KINDS, scan, written
from threadmill.llm.substring_dedup import dedup_substrings
from threadmill.llm.topk_search import integer_vectors, top_k
from threadmill.llm.toxicity import score_toxicity
from threadmill.llm.warc import archive_index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's vocabulary, from the installed data package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over 4-word shingles, similarity 0.80 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from each document."""
    d = allocate(sized(table(spark, sf_dir, "documents")))
    return d.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for each vector whose vec_id is divisible by 100."""
    v = integer_vectors(table(spark, sf_dir, "embeddings"), scale=1024)
    return top_k(v, v.where("vec_id % 100 = 0"), k=10)


def fold(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % n


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    d = identify(docs, docs.where(fold(4) != 2))
    return d.select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    d = scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(KINDS[:3])
    ]
    return d.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after dropping 13-word windows that smaller documents hold."""
    d = dedup_substrings(table(spark, sf_dir, "documents"), window=13)
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after dropping keys that three documents or more hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d, n, dropped = dedup_lines(docs, min_chars=20, min_docs=3)
    return d.select(
        "doc_id",
        F.col(n).alias("n_lines"),
        F.col(dropped).alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from two thirds of the labels."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(3) != 1)
    d = score_toxicity(table(spark, sf_dir, "documents"), labels)
    return d.select(
        "doc_id",
        F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d, n, ids, decoded = encode_documents(docs, vocabulary_file())
    return d.select(
        "doc_id",
        F.col(n).alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the forest's verdict on every document."""
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, from the merged index of the archives. The
    table has no capture times; page_id seconds after 1970 stand in for them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    captured = F.timestamp_seconds(F.pmod(F.col("page_id"), F.lit(2**31)))
    d = archive_index(pages, captured, min_bytes=0)
    return d.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of an anchor's five positives."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = labelled_vectors(v.withColumn("label", moved), scale=256)
    return mine_negatives(v, v.where("vec_id % 50 = 0"), positives=5, negatives=3, low=50, high=95)


#: Words of a text, as a DuckDB expression over the column ``text``.
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SQL_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL["op6_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
),
least AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM win JOIN least USING (k) WHERE doc_id > first_doc
),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
left_over AS (
  SELECT word.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY word.p) AS t
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p
  WHERE gone.p IS NULL GROUP BY word.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN left_over ON d.doc_id = left_over.doc_id
"""

ORACLE_SQL["op7_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS p, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, {SQL_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
),
common AS (
  SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT keyed.*, coalesce(doc_id < last_doc, false) AS gone FROM keyed LEFT JOIN common ON keyed.k = common.k
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE_SQL["op1_minhash_dedup"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3
  )
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
inter AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
link AS (
  SELECT a, b FROM inter JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * i >= 80 * (p.n + q.n - i)
),
reach AS (
  SELECT doc_id AS id, doc_id AS r FROM d
  UNION SELECT link.b, reach.r FROM reach JOIN link ON link.a = reach.id WHERE reach.r < link.b
)
SELECT d.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(reach.r) AS component_id,
       d.doc_id = min(reach.r) AS kept
FROM d JOIN reach ON reach.id = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id GROUP BY d.doc_id
"""

ORACLE_SQL["op3_topk_search"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v) AS n FROM v) q
  JOIN v x ON x.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0 AND q.n = 1
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

SQL_TERMS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLE_SQL["op11_lexical_search"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {SQL_TERMS.format("coalesce(text, '')")} AS t
  FROM documents WHERE doc_id IS NOT NULL
),
corpus AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({SQL_TERMS.format("coalesce(min(text), '')")}) AS term
        FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)
  GROUP BY ALL
),
tf AS (
  SELECT r, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY r, doc_id, term
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
posting AS (
  SELECT term, r, doc_id,
         CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
         * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS points
  FROM tf JOIN df USING (term), corpus
),
scored AS (
  SELECT item_id, r, doc_id, CAST(sum(times * points) AS BIGINT) AS score
  FROM q JOIN posting USING (term) GROUP BY item_id, r, doc_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

#: Four base32 digits for each five digits of the hexadecimal SHA-1.
SQL_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) >> {s}) & 31), 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)

ORACLE_SQL["op12_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS winner FROM p)
SELECT page_id, octet_length(encode(x)) AS payload_bytes, {SQL_BASE32} AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM winner THEN winner END AS refers_to
FROM w
"""

ORACLE_SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
a AS (
  SELECT vec_id, label, v FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY label, v) AS n FROM v WHERE vec_id % 50 = 0
  ) WHERE n = 1
),
scored AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * x.v[i])) AS BIGINT) AS score
  FROM a JOIN v x ON x.vec_id <> a.vec_id
),
positive AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS turn FROM scored WHERE same
  ) WHERE turn <= 5
),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.turn ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positive p JOIN scored n
    ON n.anchor_id = p.anchor_id AND NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
