"""Pair scoring and reranking.

Default scorer: Okapi BM25 (Robertson & Zaragoza 2009) over a stored index
(``bm25_index``): statistics cover the whole corpus, which is tokenised once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from . import bm25_index as BX
from .hooks import once_a_worker


def bm25_pairs(pairs: DataFrame, corpus: DataFrame, queries: DataFrame, id_col: str, text_col: str, qid: str = "query_id",
               qtext: str = "query_text", k1: float = C.BM25_K1, b: float = C.BM25_B) -> DataFrame:
    """BM25 score for given (query_id, id) candidate pairs (rerank, I7), with
    statistics over the whole corpus. For several batches build the index once
    and call ``bm25_index.pair_scores``. Output ``query_id, <id_col>, rerank_score``."""
    return BX.pair_scores(BX.build_index(corpus, id_col, text_col, k1=k1, b=b), pairs, queries, id_col, qid, qtext)


def bm25_topk(corpus: DataFrame, queries: DataFrame, id_col: str, text_col: str, k: int = C.TOPN_RERANK, qid: str = "query_id",
              qtext: str = "query_text", k1: float = C.BM25_K1, b: float = C.BM25_B) -> DataFrame:
    """Top-``k`` documents per query by BM25 over the whole corpus, ranked by (score
    rounded to 6 places desc, id asc). For several batches build the index once
    and call ``bm25_index.top_documents``."""
    return BX.top_documents(BX.build_index(corpus, id_col, text_col, k1=k1, b=b), queries, id_col, k, qid, qtext)


def pair_scorer_udf(factory: Callable):
    """Pluggable cross-encoder hook (L2): ``factory()`` gives ``scorer(queries, texts)
    -> scores``, built once a Python worker and called once per Arrow batch of pairs."""
    model = once_a_worker(factory)

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = model()
        for q, t in batches:
            yield pd.Series(scorer(q.fillna("").tolist(), t.fillna("").tolist()), dtype="float64")

    return run


def rerank_topn(scored: DataFrame, n: int = C.TOPN_RERANK, qid: str = "query_id",
                score: str = "rerank_score", prior_rank: str = "rank") -> DataFrame:
    """Keep the best ``n`` per query by rerank score; ties keep the earlier
    vector rank (stable descending sort, S17)."""
    n = n or C.TOPN_RERANK
    w = Window.partitionBy(qid).orderBy(F.col(score).desc(), F.col(prior_rank).asc())
    return scored.withColumn("rerank_rank", F.row_number().over(w)).where(F.col("rerank_rank") <= n)
