"""Registered queries: chunks, vectors, search, rerank, prompts, dedupe (I, C8, C9, D12, A17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as tx
from ..operators import bm25_index as BX
from ..operators import cells as CE
from ..operators import chunks as CH
from ..operators import dedupe as DD
from ..operators import index_table as IX
from ..operators import prompts as PR
from ..operators import rerank as RR
from ..operators import vectors as VE
from ..sources import files as io
from ..session import scratch_path
from . import sqlkit as S
from . import views as V
from .registry import query

W = V.with_views
SPEC = C.ChunkSpec()
K_DOCS = 10          # top-k of the document search query (embed_hashed)
K_CHUNKS = C.TOPK_RETRIEVE
N_RERANK = C.TOPN_RERANK
K1, B = C.BM25_K1, C.BM25_B
RECENT_FROM = V.AS_OF_EPOCH - C.INGEST_DAYS * 86400


# ---------------------------------------------------------------------------
# Spark building blocks
# ---------------------------------------------------------------------------

def posts_for_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.posts_v(spark, sf_dir).withColumn("permalink", tx.permalink("permalink_path"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CH.post_chunks(posts_for_index(spark, sf_dir), SPEC)


def earlier_draft(text: str):
    """Stand-in input: a longer, older text of a post (its chunks must go when the post lands again)."""
    return F.concat(F.repeat(F.lit("draft "), 400), F.coalesce(F.col(text), F.lit("")))


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return VE.embed_hashed(V.queries_v(spark, sf_dir), "query_text", "qvec")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenised_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk table with its tokens, written once: vectors and BM25 read them there."""
    return _written(chunks(spark, sf_dir).withColumn("tokens", tx.tokens(F.col("chunk_text"))), "chunks")


def candidates_of(ch: DataFrame, queries: DataFrame) -> DataFrame:
    vec = ch.select("chunk_id", VE.buckets_of(F.col("tokens")).alias("buckets"))
    return VE.topk_exact(vec, queries, K_CHUNKS, id_col="chunk_id", vec_col="buckets", bucket_dims=C.HASH_DIMS)


def reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates -> BM25 over the whole chunk corpus -> top-n (I7, F2). The chunks are
    tokenised once; the candidate set is read by several jobs and written once."""
    ch = tokenised_chunks(spark, sf_dir)
    cand = _written(candidates_of(ch, query_vectors(spark, sf_dir)), "candidates")
    index = BX.tokens_index(ch, "chunk_id", "tokens")
    scored = BX.pair_scores(index, cand.select("query_id", "chunk_id"), V.queries_v(spark, sf_dir), "chunk_id")
    scored = scored.join(cand.select("query_id", "chunk_id", "rank", "score"), ["query_id", "chunk_id"])
    top = RR.rerank_topn(scored, N_RERANK)
    # Payload for the survivors only: a bounded (queries x n) side joined by id.
    return top.join(ch.select("chunk_id", "chunk_text", "permalink"), "chunk_id")


def snippet_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = PR.snippet_block(reranked(spark, sf_dir))
    return V.queries_v(spark, sf_dir).join(blocks, "query_id", "left").select(
        "query_id", "query_text", F.coalesce("snippets", F.lit("")).alias("snippets"),
        F.coalesce("n_snippets", F.lit(0)).alias("n_snippets"))


# ---------------------------------------------------------------------------
# Oracle SQL building blocks
# ---------------------------------------------------------------------------

CHUNKS_SQL = f"""
chunks AS (
  SELECT sha256(concat_ws(chr(1), doc_id, CAST(chunk_ix AS VARCHAR), chunk_text)) AS chunk_id, doc_id, chunk_ix,
         chunk_text, permalink, subreddit, score, created_utc
  FROM (SELECT id AS doc_id, CAST(i / {SPEC.step} AS INTEGER) AS chunk_ix, substr(body, i + 1, {SPEC.size}) AS chunk_text,
               {S.lit(C.PERMALINK_BASE)} || coalesce(permalink_path, '') AS permalink, coalesce(subreddit, '') AS subreddit,
               CAST(coalesce(score, 0) AS BIGINT) AS score, CAST(coalesce(created_utc, 0) AS DOUBLE) AS created_utc
        FROM (SELECT *, {S.strip("coalesce(title, '') || chr(10) || coalesce(selftext, '')")} AS body FROM posts_v) p,
             unnest(range(0, length(body), {SPEC.step})) AS u(i))
)"""


def hashed_sim_sql(doc_table: str, doc_id: str, doc_text: str, prefix: str) -> str:
    """CTEs ``{prefix}sim(query_id, id, score)`` = rounded cosine of hashed
    term vectors for every (query, doc) pair (0 when nothing is shared)."""
    p = prefix
    return f"""
{p}dv AS (SELECT id, b, count(*) AS c FROM (
    SELECT {doc_id} AS id, {S.bucket('tok')} AS b FROM {doc_table}, unnest({S.tokens_unnest(doc_text)}) AS u(tok) WHERE tok <> '')
  GROUP BY 1, 2),
{p}dn AS (SELECT id, sqrt(sum(c * c)) AS n FROM {p}dv GROUP BY 1),
{p}qv AS (SELECT query_id, b, count(*) AS c FROM (
    SELECT query_id, {S.bucket('tok')} AS b FROM queries_v, unnest({S.tokens_unnest('query_text')}) AS u(tok) WHERE tok <> '')
  GROUP BY 1, 2),
{p}qn AS (SELECT query_id, sqrt(sum(c * c)) AS n FROM {p}qv GROUP BY 1),
{p}dot AS (SELECT q.query_id, d.id, sum(q.c * d.c) AS dp FROM {p}qv q JOIN {p}dv d ON q.b = d.b GROUP BY 1, 2),
{p}sim AS (
  SELECT q.query_id, d.id, round(coalesce(dot.dp / (qn.n * dn.n), 0.0), 6) AS score
  FROM queries_v q CROSS JOIN (SELECT {doc_id} AS id FROM {doc_table}) d
  LEFT JOIN {p}dot dot ON dot.query_id = q.query_id AND dot.id = d.id
  LEFT JOIN {p}qn qn ON qn.query_id = q.query_id
  LEFT JOIN {p}dn dn ON dn.id = d.id)"""


def topk_sql(sim: str, k: int) -> str:
    return f"""(SELECT query_id, id, score, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM {sim}) WHERE rank <= {k})"""


def bm25_sql(prefix: str, corpus: str, cid: str, ctext: str, pairs: str | None) -> str:
    """CTE ``{prefix}bm(query_id, id, score)``: BM25 with whole-corpus stats,
    for all docs sharing a term (pairs None) or only for candidate pairs."""
    p = prefix
    toks = S.tokens_unnest(ctext)
    sql = f"""
{p}qt AS (SELECT DISTINCT query_id, tok FROM queries_v, unnest({S.tokens_unnest('query_text')}) AS u(tok) WHERE tok <> ''),
{p}dl AS (SELECT {cid} AS id, len(list_filter({toks}, lambda x: x <> '')) AS dl FROM {corpus}),
{p}st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {p}dl),
{p}tf AS (SELECT id, tok, count(*) AS tf FROM (SELECT {cid} AS id, tok FROM {corpus}, unnest({toks}) AS u(tok)
          WHERE tok IN (SELECT tok FROM {p}qt)) GROUP BY 1, 2),
{p}idf AS (SELECT tok, ln(1 + ((SELECT n FROM {p}st) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM {p}tf GROUP BY 1),
{p}raw AS (SELECT qt.query_id, tf.id,
    round(sum(idf.idf * tf.tf * {K1 + 1.0} / (tf.tf + {K1} * ({1.0 - B} + {B} * dl.dl / (SELECT avgdl FROM {p}st)))), 6) AS score
  FROM {p}qt qt JOIN {p}tf tf ON qt.tok = tf.tok JOIN {p}idf idf ON idf.tok = tf.tok JOIN {p}dl dl ON dl.id = tf.id
  {'' if pairs is None else f'JOIN {pairs} pr ON pr.query_id = qt.query_id AND pr.id = tf.id'}
  GROUP BY 1, 2)"""
    return sql


RETRIEVAL_BASE = (V.POSTS_V_SQL.strip() + ",\n" + V.QUERIES_V_SQL.strip() + ",\n" + CHUNKS_SQL.strip() + ","
                  + hashed_sim_sql("chunks", "chunk_id", "chunk_text", "c_") + ",\n"
                  + f"cand AS {topk_sql('c_sim', K_CHUNKS)},"
                  + bm25_sql("r_", "chunks", "chunk_id", "chunk_text", "cand") + ",\n"
                  + f"""rr AS (SELECT cand.query_id, cand.id AS chunk_id, cand.rank, cand.score, coalesce(r.score, 0.0) AS rerank_score
  FROM cand LEFT JOIN r_raw r ON r.query_id = cand.query_id AND r.id = cand.id),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS BIGINT) AS rerank_rank FROM rr)
        WHERE rerank_rank <= {N_RERANK}),
topx AS (SELECT top.*, c.chunk_text, c.permalink FROM top JOIN chunks c USING (chunk_id)),
blocks AS (SELECT q.query_id, q.query_text,
    coalesce(string_agg('- ' || replace(t.chunk_text, chr(10), ' ') || ' (link: ' || t.permalink || ')', chr(10) ORDER BY t.rerank_rank), '') AS snippets,
    count(t.chunk_id) AS n_snippets
  FROM queries_v q LEFT JOIN topx t USING (query_id) GROUP BY 1, 2)
""")


def _w(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n"


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

@query("post_chunks", _w(V.POSTS_V_SQL, CHUNKS_SQL) + "SELECT * FROM chunks")
def q_post_chunks(spark, sf_dir):
    """Posts -> overlapping chunks with payload and deterministic ids."""
    return chunks(spark, sf_dir)


@query("comment_chunks", _w(V.COMMENTS_V_SQL) + f"""SELECT sha256(concat_ws(chr(1), doc_id, CAST(chunk_ix AS VARCHAR), chunk_text)) AS chunk_id,
  doc_id, chunk_ix, chunk_text, post_id, score FROM (
  SELECT id AS doc_id, CAST(i / {SPEC.step} AS INTEGER) AS chunk_ix, substr(body, i + 1, {SPEC.size}) AS chunk_text, post_id, score
  FROM (SELECT id, post_id, score, {S.clean('body')} AS body FROM comments_v
        WHERE body IS NOT NULL AND body <> '' AND body NOT IN ('[deleted]', '[removed]')) c,
       unnest(range(0, length(body), {SPEC.step})) AS u(i))""")
def q_comment_chunks(spark, sf_dir):
    """Comments -> overlapping chunks from their body column."""
    return CH.comment_chunks(V.comments_v(spark, sf_dir)).select("chunk_id", "doc_id", "chunk_ix", "chunk_text", "post_id", "score")


@query("chunk_id", _w(V.POSTS_V_SQL, CHUNKS_SQL) + "SELECT doc_id, chunk_ix, chunk_id FROM chunks")
def q_chunk_id(spark, sf_dir):
    """Deterministic chunk ids: sha256(doc_id, chunk_ix, text)."""
    return chunks(spark, sf_dir).select("doc_id", "chunk_ix", "chunk_id")


@query("embed_hashed", _w(V.QUERIES_V_SQL, hashed_sim_sql("documents", "doc_id", "text", "d_"))
       + f"SELECT query_id, id AS doc_id, score, rank FROM {topk_sql('d_sim', K_DOCS)}")
def q_embed_hashed(spark, sf_dir):
    """Hashed-term embeddings of documents and queries; top-10 documents per
    query by cosine (I2, I3, I4, I5)."""
    docs = VE.hashed_buckets(V.read(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    top = VE.topk_exact(docs, query_vectors(spark, sf_dir), K_DOCS, id_col="doc_id", vec_col="buckets",
                        bucket_dims=C.HASH_DIMS)
    return top.select("query_id", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


def _centroid_sql(filter_sql: str = "", k: int = K_CHUNKS) -> str:
    return f"""WITH ev AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
cent AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM ev GROUP BY 1, 2),
cn AS (SELECT label, sqrt(sum(m * m)) AS n FROM cent GROUP BY 1),
qv AS (SELECT CAST(c.label AS BIGINT) AS query_id, list(c.m / cn.n ORDER BY c.i) AS qvec FROM cent c JOIN cn USING (label) GROUP BY 1),
s AS (SELECT qv.query_id, v.vec_id AS id, round(list_dot_product(qv.qvec, CAST(v.embedding AS DOUBLE[])), 6) AS score
      FROM qv, (SELECT *, vec_id % 100 AS score FROM embeddings) v {filter_sql})
SELECT query_id, id AS vec_id, score, rank FROM {topk_sql('s', k)}"""


def _centroid_queries(spark, sf_dir):
    vec = V.vectors_v(spark, sf_dir)
    return VE.centroids(vec, "label").select(F.col("label").cast("bigint").alias("query_id"), "qvec")


@query("vector_topk", _centroid_sql())
def q_vector_topk(spark, sf_dir):
    """Exact cosine top-200 over the whole vector table for a batch of queries
    (per-label centroids) (I5, C8, E2, F1, I4)."""
    top = VE.topk_exact(V.vectors_v(spark, sf_dir), _centroid_queries(spark, sf_dir), K_CHUNKS)
    return top.select("query_id", "vec_id", "score", F.col("rank").cast("bigint").alias("rank"))


@query("vector_topk_filtered", _centroid_sql("WHERE v.score >= 50"))
def q_vector_topk_filtered(spark, sf_dir):
    """Top-k restricted by a payload filter applied before scoring."""
    from ..operators.posts import payload_filter
    top = VE.topk_exact(V.vectors_v(spark, sf_dir), _centroid_queries(spark, sf_dir), K_CHUNKS,
                        where=payload_filter({"min_score": 50}))
    return top.select("query_id", "vec_id", "score", F.col("rank").cast("bigint").alias("rank"))


@query("vector_topk_ivf")
def q_vector_topk_ivf(spark, sf_dir):
    """Approximate top-k over cells whose number grows with the table, read as byte codes
    and probed as far as the expected misses ask for (I6). Rows-only check; see ``vector_ivf_recall``."""
    index = CE.build_cells(V.vectors_v(spark, sf_dir))
    top = CE.topk_cells(index, _centroid_queries(spark, sf_dir), k=10)
    return top.select("query_id", "vec_id", "score", F.col("rank").cast("bigint").alias("rank"))


@query("vector_ivf_recall", "SELECT TRUE AS recall_reached, count(DISTINCT label) AS n_queries FROM embeddings")
def q_vector_ivf_recall(spark, sf_dir):
    """Recall at 10 of the approximate search against the exact one is 0.9 or more."""
    queries = _written(_centroid_queries(spark, sf_dir), "queries")
    exact = VE.topk_exact(V.vectors_v(spark, sf_dir), queries, 10).select("query_id", "vec_id")
    found = CE.topk_cells(CE.build_cells(V.vectors_v(spark, sf_dir)), queries, k=10).select("query_id", "vec_id", F.lit(1).alias("hit"))
    both = exact.join(found, ["query_id", "vec_id"], "left")
    return both.agg((F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
                    F.count_distinct("query_id").alias("n_queries"))


@query("vector_topk_ivf_all", _centroid_sql(k=10))
def q_vector_topk_ivf_all(spark, sf_dir):
    """The cell index with every cell probed gives the exact answer."""
    index = CE.build_cells(V.vectors_v(spark, sf_dir), cells=8)
    top = CE.topk_cells(index, _centroid_queries(spark, sf_dir), k=10, missed=0.0)
    return top.select("query_id", "vec_id", "score", F.col("rank").cast("bigint").alias("rank"))


@query("embed_documents", _w(V.QUERIES_V_SQL, hashed_sim_sql("documents", "doc_id", "text", "d_"))
       + "SELECT v.id AS doc_id, CAST(b AS BIGINT) AS bucket, round(c / n, 6) AS weight FROM d_dv v JOIN d_dn USING (id)")
def q_embed_documents(spark, sf_dir):
    """Every non-zero component of every document's hashed vector."""
    d = VE.embed_hashed(V.read(spark, sf_dir, "documents").select("doc_id", "text"), "text", "vec")
    d = d.select("doc_id", F.posexplode("vec").alias("bucket", "weight")).where(F.col("weight") > 0)
    return d.select("doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("weight").cast("double"), 6).alias("weight"))


@query("l2_normalize", """SELECT vec_id, CAST(i AS INTEGER) AS i, round(CAST(embedding[i] AS DOUBLE) / norm, 6) AS x FROM (
  SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS norm,
         unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def q_l2_normalize(spark, sf_dir):
    """Native L2 normalisation in double: every component of every vector (I4)."""
    v = V.read(spark, sf_dir, "embeddings").select("vec_id", VE.l2_normalize(F.col("embedding")).alias("v"))
    return v.select("vec_id", F.posexplode("v").alias("i", "x")).select("vec_id", (F.col("i") + 1).alias("i"), F.round("x", 6).alias("x"))


class LetterModel:
    """Stand-in for a caller's model: counts of five vowels, and one."""

    def embed(self, texts):
        return [[t.count(x) for x in "aeiou"] + [1] for t in texts]

    def score(self, queries, texts):
        return [float(len(t) - len(q)) for q, t in zip(queries, texts)]

    def complete(self, rows):
        rows = rows[["query_id", "user_prompt"]].copy()
        rows["completion"] = rows.pop("user_prompt").str.upper().str.slice(0, 100)
        return rows


_VOWELS = [f"len({{0}}) - len(replace({{0}}, '{x}', ''))" for x in "aeiou"]


@query("embed_with_model", f"""SELECT doc_id, round(a / n, 6) AS a, round(u / n, 6) AS u, round(1 / n, 6) AS one FROM (
  SELECT doc_id, a, u, sqrt(a * a + e * e + i * i + o * o + u * u + 1) AS n FROM (
    SELECT doc_id, {', '.join(v.format('t') + ' AS ' + x for v, x in zip(_VOWELS, 'aeiou'))} FROM (
      SELECT doc_id, coalesce(text, '') AS t FROM documents)))""")
def q_embed_with_model(spark, sf_dir):
    """A caller's embedder, built once a Python worker, over every document (L1)."""
    d = V.read(spark, sf_dir, "documents").select("doc_id", "text")
    d = VE.embed_with(d, "text", lambda: LetterModel().embed, dims=6, out_col="v")
    at = {"a": 0, "u": 4, "one": 5}
    return d.select("doc_id", *[F.round(F.get("v", F.lit(i)), 6).alias(x) for x, i in at.items()])


@query("score_with_model", _w(V.POSTS_V_SQL, CHUNKS_SQL) + """SELECT c.chunk_id, CAST(length(c.chunk_text) - length(coalesce(p.title, '')) AS DOUBLE) AS score
FROM chunks c JOIN posts_v p ON p.id = c.doc_id""")
def q_score_with_model(spark, sf_dir):
    """A caller's pair scorer, built once a Python worker, over every (title, chunk) pair (L2)."""
    titles = V.posts_v(spark, sf_dir).select(F.col("id").alias("doc_id"), "title")
    pairs = chunks(spark, sf_dir).join(titles, "doc_id")
    return pairs.select("chunk_id", RR.pair_scorer_udf(lambda: LetterModel().score)("title", "chunk_text").alias("score"))


@query("complete_with_model", f"""SELECT conv_id * 1000 + turn AS query_id,
  substr(upper(format({S.fmt_template(C.SCORING_USER, ['ideas'])}, text)), 1, 100) AS completion FROM conversations""")
def q_complete_with_model(spark, sf_dir):
    """A caller's completion function, built once a Python worker, over the scoring prompt of every turn (L3)."""
    c = V.read(spark, sf_dir, "conversations").withColumn("query_id", F.col("conv_id") * 1000 + F.col("turn"))
    return PR.complete_with(PR.prompt_scoring(c, "text").select("query_id", "user_prompt"), lambda: LetterModel().complete)


@query("bm25_scores", _w(V.QUERIES_V_SQL, bm25_sql("b_", "documents", "doc_id", "text", None))
       + f"""SELECT query_id, id AS doc_id, score, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM b_raw) WHERE rank <= {N_RERANK}""")
def q_bm25_scores(spark, sf_dir):
    """BM25 search of every benchmark query over all documents; best 25 per
    query (I7 scorer, whole-corpus statistics)."""
    docs = V.read(spark, sf_dir, "documents").select("doc_id", "text")
    top = RR.bm25_topk(docs, V.queries_v(spark, sf_dir), "doc_id", "text", N_RERANK)
    return top.select("query_id", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


@query("rerank_pairs", _w(RETRIEVAL_BASE) + """SELECT cand.query_id, cand.id AS chunk_id, cand.rank, cand.score, c.permalink
FROM cand JOIN chunks c ON c.chunk_id = cand.id""")
def q_rerank_pairs(spark, sf_dir):
    """(query, candidate) pairs joined back to the chunk payload."""
    ch = tokenised_chunks(spark, sf_dir)
    cand = candidates_of(ch, query_vectors(spark, sf_dir))
    return cand.join(ch.select("chunk_id", "permalink"), "chunk_id").select("query_id", "chunk_id", F.col("rank").cast("bigint").alias("rank"), "score", "permalink")


@query("rerank_topn", _w(RETRIEVAL_BASE) + "SELECT query_id, chunk_id, rank, rerank_score, rerank_rank FROM top")
def q_rerank_topn(spark, sf_dir):
    """BM25 rerank of the top-200 candidates, best 25 kept; ties keep the
    vector rank (I7, F2, S17)."""
    r = reranked(spark, sf_dir)
    return r.select("query_id", "chunk_id", F.col("rank").cast("bigint").alias("rank"), "rerank_score",
                    F.col("rerank_rank").cast("bigint").alias("rerank_rank"))


@query("snippet_block", _w(RETRIEVAL_BASE) + "SELECT query_id, snippets, n_snippets FROM blocks")
def q_snippet_block(spark, sf_dir):
    """Ordered snippet block per query."""
    return snippet_blocks(spark, sf_dir).select("query_id", "snippets", F.col("n_snippets").cast("bigint").alias("n_snippets"))


@query("prompt_ideas", _w(RETRIEVAL_BASE) + f"""SELECT query_id, {S.lit(C.SYSTEM_IDEAS)} AS system_prompt,
  format({S.fmt_template(C.IDEA_GEN_USER, ['n', 'snippets'])}, '{C.DEFAULT_IDEAS}', snippets) AS user_prompt FROM blocks""")
def q_prompt_ideas(spark, sf_dir):
    """Idea prompt rows per query: retrieve, rerank, snippet block, template."""
    return PR.prompt_ideas(snippet_blocks(spark, sf_dir), C.DEFAULT_IDEAS).select("query_id", "system_prompt", "user_prompt")


@query("prompt_top_docs", _w(RETRIEVAL_BASE) + """SELECT top.query_id, rerank_rank, top.chunk_id, c.permalink
FROM top JOIN chunks c ON c.chunk_id = top.chunk_id""")
def q_prompt_top_docs(spark, sf_dir):
    """The documents behind each prompt, in the order of its snippets."""
    r = reranked(spark, sf_dir)
    return r.select("query_id", F.col("rerank_rank").cast("bigint").alias("rerank_rank"), "chunk_id", "permalink")


@query("prompt_pains", _w(RETRIEVAL_BASE) + f"""SELECT query_id, {S.lit(C.PAIN_MINING_SYSTEM)} AS system_prompt,
  format({S.fmt_template(C.PAIN_MINING_USER, ['topic', 'subs', 'period', 'snippets'])}, query_text,
         {S.lit(','.join(C.DEFAULT_SUBREDDITS))}, {S.lit(C.DEFAULT_PERIOD)}, snippets) AS user_prompt FROM blocks""")
def q_prompt_pains(spark, sf_dir):
    """Pain-mining prompt rows per query."""
    b = snippet_blocks(spark, sf_dir)
    out = PR.prompt_pains(b, F.col("query_text"), F.array_join(F.array(*[F.lit(s) for s in C.DEFAULT_SUBREDDITS]), ","),
                          F.lit(C.DEFAULT_PERIOD))
    return out.select("query_id", "system_prompt", "user_prompt")


@query("prompt_scoring", f"""SELECT conv_id, turn, format({S.fmt_template(C.SCORING_USER, ['ideas'])}, text) AS user_prompt
FROM conversations""")
def q_prompt_scoring(spark, sf_dir):
    """Scoring prompt per idea text (all turns stand in for ideas)."""
    c = V.read(spark, sf_dir, "conversations")
    return PR.prompt_scoring(c, "text").select("conv_id", "turn", "user_prompt")


@query("exact_dup_groups", f"""SELECT sha256(lower({S.strip('text')})) AS text_hash, count(*) AS n_docs, min(doc_id) AS first_id
FROM documents GROUP BY 1 HAVING count(*) >= 2""")
def q_exact_dup_groups(spark, sf_dir):
    """Exact duplicate groups by normalised-text hash."""
    return DD.exact_dup_groups(V.read(spark, sf_dir, "documents"), "doc_id", "text")


#: Components of the links of similarity 0.8 or more over 5-word shingles.
NEAR_DUP_SQL = f"""WITH RECURSIVE d AS (
  SELECT doc_id, list_filter({S.tokens_unnest('text')}, lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL
),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
  )
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
inter AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM inter JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * i >= 80 * (p.n + q.n - i)
),
reach AS (
  SELECT DISTINCT a AS id, a AS r FROM link
  UNION SELECT link.b, reach.r FROM reach JOIN link ON link.a = reach.id WHERE reach.r < link.b
),
label AS (SELECT id AS doc_id, min(r) AS cluster_id FROM reach GROUP BY id),
clusters AS (SELECT doc_id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS cluster_size FROM label)
"""


@query("near_dup_clusters", NEAR_DUP_SQL + "SELECT doc_id, cluster_id, cluster_size FROM clusters")
def q_near_dup_clusters(spark, sf_dir):
    """Near-duplicate clusters: 5-word shingles, similarity 0.8 or more, confirmed on
    full sets (I12)."""
    return DD.near_dup_clusters(V.read(spark, sf_dir, "documents"), "doc_id", "text")


@query("near_dup_largest", NEAR_DUP_SQL + """SELECT CAST(row_number() OVER (ORDER BY cluster_size DESC, cluster_id) AS INTEGER) AS rank, cluster_id, cluster_size
FROM (SELECT DISTINCT cluster_id, cluster_size FROM clusters) ORDER BY rank LIMIT 20""")
def q_near_dup_largest(spark, sf_dir):
    """The 20 largest near-duplicate clusters, ranked by size."""
    return DD.largest_clusters(DD.near_dup_clusters(V.read(spark, sf_dir, "documents"), "doc_id", "text"), 20)


@query("upsert_chunks", _w(V.POSTS_V_SQL, CHUNKS_SQL) + f"""SELECT c.chunk_id, c.doc_id,
  CASE WHEN p.created_utc >= {RECENT_FROM} THEN 2 ELSE 1 END AS version FROM chunks c JOIN posts_v p ON p.id = c.doc_id""")
def q_upsert_chunks(spark, sf_dir):
    """Re-index of recent posts (A17): the index first holds longer drafts of them;
    the chunks of each re-indexed post replace all it had."""
    posts = posts_for_index(spark, sf_dir)
    recent = F.col("created_utc") >= RECENT_FROM
    drafts = posts.withColumn("selftext", F.when(recent, earlier_draft("selftext")).otherwise(F.col("selftext")))
    path = scratch_path(spark, "chunk_index")
    for version, batch in ((1, drafts), (2, posts.where(recent))):
        docs = batch.select(F.col("id").alias("doc_id"), F.lit(version).alias("version"))
        IX.replace_documents(path, CH.post_chunks(batch, SPEC), docs, batch=version, buckets=16)
    return IX.read_documents(spark, path, meta=True).select("chunk_id", "doc_id", F.col("version").cast("int").alias("version"))


@query("file_inventory", _w(V.POSTS_V_SQL) + """SELECT strftime(make_timestamp(CAST(created_utc * 1000000 AS BIGINT)), '%Y-%m-%d') AS ingest_date,
  1 AS n_files, count(*) AS n_rows, TRUE AS named, TRUE AS sized FROM posts_v GROUP BY 1""")
def q_file_inventory(spark, sf_dir):
    """Output-file inventory of a written post table, one file a date (A16, D13): files and
    rows by date, from file metadata alone; names and sizes agree with the listing."""
    df = V.posts_v(spark, sf_dir).withColumn("ingest_date", F.date_format(tx.epoch_to_ts("created_utc"), "yyyy-MM-dd"))
    path = scratch_path(spark, "inventory")
    io.write_posts(df.repartition("ingest_date"), path, fmt="parquet")
    return inventory_by_date(io.file_rows(spark.read.parquet(path)), io.file_inventory(spark, path))


def inventory_by_date(files, listed):
    """Files and rows of each date folder; ``named`` and ``sized`` say whether the listing
    holds each of them under its name and with its size."""
    listed = listed.select("path", F.col("name").alias("_name"), F.col("size_mb").alias("_mb"))
    both = files.join(listed, "path", "left")
    mb = F.round(F.col("bytes") / (1024 * 1024), 2)
    return both.groupBy(F.regexp_extract("path", "ingest_date=([^/]+)", 1).alias("ingest_date")).agg(
        F.count(F.lit(1)).cast("int").alias("n_files"), F.sum("n_rows").alias("n_rows"),
        F.bool_and(F.col("name").endswith(".parquet") & F.coalesce(F.col("name") == F.col("_name"), F.lit(False))).alias("named"),
        F.bool_and((F.col("bytes") > 0) & F.coalesce(mb == F.col("_mb"), F.lit(False))).alias("sized"))
