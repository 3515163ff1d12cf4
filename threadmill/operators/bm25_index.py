"""A stored BM25 index and searches that skip blocks which cannot matter.

The corpus is tokenised once, and a task writes the index of what it has tokenised:
nothing is shuffled. It cuts its documents into segments (``SEGMENT`` documents, fewer
where they hold ``HITS`` postings). ``documents`` has a row a document: its segment, its
place there (in the order of ids) and its id. ``postings`` has a row for each (term,
segment): the documents of the segment that hold the term, with counts and lengths, and
the block's peaks, those hits that no other one beats in both count and length; the
block's largest contribution to a score is that of a peak, whatever the average length.
A term that all documents hold is thus many bounded rows. N and the average length are
known, and the document frequencies are the sums of the block sizes. Any number of query
batches read these tables.

Scores of given pairs need no postings: ``tokens_index`` takes a stored table of tokens
as it is, counts the documents of the queries' terms there, and the terms of the
candidate documents only.

A search first reads the peaks of the queries' terms only (the arrays are not read):
their sum, weighted by idf, bounds every score a segment can hold for a query. The most
promising ``FIRST`` segments of each query are scored (the blocks of the queries' terms
are dealt by segment, whose task sums them up for one query after another and keeps the
``k`` best), which gives a threshold, the k-th score so far; then the segments whose
bound reaches it. All others are skipped. The answer is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import text as tx
from ..session import scratch_path
from .bm25_segments import best_of_segment, inverted
from .components import written
from .layout import spread

SEGMENT = 2048
FIRST = 4
#: (query, document) scores that a task sums up.
PAIRS = 1 << 22
#: Postings of a segment, about (one document at least).
HITS = 1 << 21
#: Terms of queries that meet a segment at once, about (one query at least).
ASKED = 1 << 18
#: Terms of queries up to which they are brought to the postings, which then stay where they are.
BROADCAST = 1 << 18
SCORE_DP = 6
#: More than rounding can add to a score.
SLACK = 1e-5


@dataclass
class Bm25Index:
    documents: DataFrame  # id, and segment and at, or dl and tokens
    postings: DataFrame | None  # term, segment, n, peaks array<struct<tf, dl>>, and a place a hit in at, tf and dl
    n: int
    average: float
    k1: float
    b: float

    def weights(self, terms: DataFrame) -> DataFrame:
        """(term, idf) of those of ``terms`` (term) that the corpus holds."""
        wanted = terms.select("term").distinct()
        if self.postings is not None:
            df = self.postings.select("term", "n").join(wanted, "term").groupBy("term").agg(F.sum("n").alias("df"))
        else:
            held = self.documents.select(F.explode(F.array_distinct("tokens")).alias("term"))
            df = held.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        return df.select("term", self.idf().alias("idf"))

    def idf(self) -> Column:
        """Weight of a term that ``df`` documents hold."""
        return F.ln(F.lit(1.0) + (F.lit(float(self.n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))

    def part(self, tf: Column, dl: Column) -> Column:
        """Contribution of a term to a score, before idf."""
        average = self.average if self.average > 0 else 1.0
        return tf * F.lit(self.k1 + 1.0) / (tf + F.lit(self.k1) * (F.lit(1.0 - self.b) + F.lit(self.b) * dl / F.lit(average)))


def _parts(spark: SparkSession, least: float) -> int:
    """Partitions of a shuffle: the session's number, more where the rows call for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(least))


def query_terms(queries: DataFrame, qid: str = "query_id", qtext: str = "query_text") -> DataFrame:
    """Distinct tokens per query."""
    return queries.select(F.col(qid).alias("query_id"), F.explode(F.array_distinct(tx.tokens(F.col(qtext)))).alias("term"))


def tokens_index(tokenised: DataFrame, id_col: str, tokens_col: str, k1: float = C.BM25_K1, b: float = C.BM25_B) -> Bm25Index:
    """What ``pair_scores`` needs of a stored table of tokens: nothing is written."""
    docs = tokenised.select(F.col(id_col).alias("id"), F.size(tokens_col).cast("long").alias("dl"), F.col(tokens_col).alias("tokens"))
    n, length = docs.agg(F.count(F.lit(1)), F.sum("dl")).first()
    return Bm25Index(docs, None, n, (length or 0) / n if n else 0.0, k1, b)


def build_index(corpus: DataFrame, id_col: str, text_col: str, k1: float = C.BM25_K1, b: float = C.BM25_B) -> Bm25Index:
    """Index of ``corpus``, for searches and pair scores."""
    spark = corpus.sparkSession
    rows = spread(corpus).select(F.col(id_col).alias("id"), tx.tokens(F.col(text_col)).alias("tokens"))
    kind = rows.schema["id"].dataType
    if isinstance(kind, (T.StructType, T.ArrayType)):  # Arrow does not order these
        rows = rows.sortWithinPartitions("id")
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.size("tokens").cast("long")).alias("length"))
    schema = "term string, segment long, n long, peaks array<struct<tf: int, dl: int>>, at array<int>, tf array<int>, dl array<int>"
    schema = T.StructType.fromDDL(schema).add("ids", T.ArrayType(kind))
    path = scratch_path(spark, "bm25_index")
    rows.select(F.monotonically_increasing_id().alias("no"), "id", "tokens").mapInArrow(inverted(SEGMENT, HITS), schema).write.option(
        "compression", "zstd").parquet(path)
    n, length = seen.get["n"] or 0, seen.get["length"] or 0
    table = spark.read.schema(schema).parquet(path)
    docs = table.where(F.col("ids").isNotNull()).select("segment", F.posexplode("ids").alias("at", "id"))
    postings = table.where(F.col("term").isNotNull()).drop("ids")
    return Bm25Index(docs, postings, n, length / n if n else 0.0, k1, b)


def _few(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= BROADCAST else rows


def pair_scores(index: Bm25Index, pairs: DataFrame, queries: DataFrame, id_col: str, qid: str = "query_id",
                qtext: str = "query_text") -> DataFrame:
    """BM25 score for given (query_id, id) candidate pairs (rerank, I7): the stored
    term counts of the candidate documents, never their texts. Pairs without a shared
    term score 0. Output ``query_id, <id_col>, rerank_score``."""
    qt = query_terms(queries, qid, qtext)
    wanted = index.weights(qt)
    cand = pairs.select(F.col(qid).alias("query_id"), F.col(id_col).alias("id"))
    docs = index.documents.join(cand.select("id").distinct(), "id", "left_semi")
    if index.postings is not None:
        blocks = index.postings.select("term", "segment", "at", "tf", "dl").join(wanted, "term")
        blocks = blocks.join(docs.select("segment").distinct(), "segment", "left_semi")
        hits = blocks.select("term", "segment", "idf", F.explode(F.arrays_zip("at", "tf", "dl")).alias("h")).select(
            "segment", F.col("h.at").alias("at"), "term", index.part(F.col("h.tf"), F.col("h.dl")).alias("part"), "idf")
        hits = hits.join(docs, ["segment", "at"])
    else:
        counts = tx.with_term_counts(docs, "tokens", "counts")
        hits = counts.select("id", "dl", F.explode_outer("counts").alias("c")).where(F.col("c").isNotNull())
        hits = hits.select("id", F.col("c.term").alias("term"), index.part(F.col("c.tf"), F.col("dl")).alias("part")).join(wanted, "term")
    scored = hits.join(cand, "id").join(qt, ["query_id", "term"]).groupBy("query_id", "id").agg(
        F.round(F.sum(F.col("idf") * F.col("part")), SCORE_DP).alias("score"))
    return cand.join(scored, ["query_id", "id"], "left").select(
        F.col("query_id").alias(qid), F.col("id").alias(id_col), F.coalesce("score", F.lit(0.0)).alias("rerank_score"))


def top_documents(index: Bm25Index, queries: DataFrame, id_col: str, k: int = C.TOPN_RERANK, qid: str = "query_id",
                  qtext: str = "query_text", skipped: list | None = None) -> DataFrame:
    """The ``k`` best documents per query over the whole corpus: ``query_id, <id_col>,
    score, rank`` by (score rounded to 6 places descending, id ascending). ``skipped``,
    where given, collects (segments of all queries, segments scored)."""
    terms = written(query_terms(queries, qid, qtext), "bm25_query_terms")
    known = written(terms.select("term").distinct().withColumn("tid", F.monotonically_increasing_id()), "bm25_terms")
    n = known.count()
    # only the peaks are read here
    most = F.array_max(F.transform("peaks", lambda p: index.part(p["tf"], p["dl"])))
    heads = index.postings.select("term", "segment", "n", "peaks").join(_few(known, n), "term")
    heads = written(heads.select("tid", "segment", "n", most.alias("most")), "bm25_heads")
    weights = heads.groupBy("tid").agg(F.sum("n").alias("df")).select("tid", index.idf().alias("idf"))
    known = written(known.join(weights, "tid"), "bm25_weights")
    parts = math.ceil(max(terms.count(), 1) / ASKED)
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).alias("part")
    qt = written(terms.join(known, "term").select(part, "query_id", "tid", "idf"), "bm25_query_weights")
    asks = qt.groupBy("part", "query_id").agg(F.sort_array(F.collect_list("tid")).alias("tids"))
    known = known.join(qt.select("part", "tid").distinct(), "tid").select("part", "term", "tid", "idf")
    bounds = heads.join(qt, "tid").groupBy("query_id", "segment").agg(F.sum(F.col("idf") * F.col("most")).alias("bound"))
    turn = Window.partitionBy("query_id").orderBy(F.desc("bound"), "segment")
    bounds = written(bounds.withColumn("turn", F.row_number().over(turn)), "bm25_bounds")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    found = T.StructType([terms.schema["query_id"], *T.StructType.fromDDL("segment long, at int, score double")])

    def scored(due: DataFrame) -> DataFrame:
        """What may be among the k best of the due segments (query_id, segment, floor), with ids: (query_id, id, score)."""
        tasks = _parts(due.sparkSession, due.count() * SEGMENT / PAIRS)
        asked = due.join(asks, "query_id").select(F.col("part").alias("a_part"), F.col("segment").alias("a_segment"), "query_id", "floor", "tids")
        blocks = index.postings.select("term", "segment", "at", "tf", "dl").join(_few(known, n), "term")
        blocks = blocks.join(F.broadcast(due.select("segment").distinct()), "segment", "left_semi")  # one row for many documents
        blocks = blocks.select("part", "segment", "tid", "idf", "at", "tf", "dl").repartition(tasks, "part", "segment")
        few = asked.repartition(tasks, "a_part", "a_segment").groupBy("a_part", "a_segment").cogroup(blocks.groupBy("part", "segment")).applyInArrow(
            best_of_segment(k, index.k1, index.b, index.average or 1.0, SCORE_DP, SLACK), found)
        return few.join(index.documents, ["segment", "at"]).select("query_id", "id", F.round("score", SCORE_DP).alias("score"))

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    early = F.col("turn") <= FIRST
    first = written(ranked(scored(bounds.where(early).withColumn("floor", F.lit(None).cast("double")))), "bm25_first")
    floor = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    late = bounds.where(~early).join(floor, "query_id", "left")
    late = written(late.where(F.col("floor").isNull() | (F.col("bound") + SLACK >= F.col("floor"))).select("query_id", "segment", "floor"), "bm25_due")
    if skipped is not None:
        skipped.append((bounds.count(), bounds.where(early).count() + late.count()))
    out = ranked(first.drop("rank").unionByName(scored(late)))
    return out.select("query_id", F.col("id").alias(id_col), "score", "rank")
