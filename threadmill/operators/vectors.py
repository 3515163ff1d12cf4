"""Text -> vectors and batched top-k similarity search.

Exact search plan (per batch of queries):

1. the query matrix is a *side input*: its size (queries x dims x 8 bytes) is
   checked against ``max_side_bytes``, with what a task keeps for each query; a
   larger query set is cut into blocks that each fit, and the blocks are answered
   one after another, so the driver holds one block at a time. Each block is a scan:
   a block of some 10,000 queries costs a vector some 10**6 multiplications, beside
   which reading it again is little;
2. every partition of the (possibly filtered, pushed-down) vector table is
   scored with one blocked matrix product inside ``mapInPandas`` and keeps only
   its local top-k per query (plus exact ties), so at most
   ``partitions x queries x k`` rows reach the shuffle;
3. a ``row_number() <= k`` window per query (WindowGroupLimit) gives the
   global top-k. Scores are rounded to 6 decimals *in Spark*; ranking is by
   (rounded score desc, id asc), which makes results repeatable.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import text as tx
from .components import written
from .hooks import once_a_worker
from .layout import spread
from .topk import bounded_topk

MAX_SIDE_BYTES = 64 * 1024 * 1024
SCORE_DP = 6
#: Rows and list entries of an Arrow batch that are made dense at once; a longer row is worked on alone.
SLICE_ROWS, SLICE_ENTRIES = 1024, 1 << 18


# ---------------------------------------------------------------------------
# Embedding
# ---------------------------------------------------------------------------

def token_buckets(text: Column, dims: int = C.HASH_DIMS) -> Column:
    """Hash bucket of every token of ``text`` (JVM-side md5)."""
    return buckets_of(tx.tokens(text), dims)


def buckets_of(tokens: Column, dims: int = C.HASH_DIMS) -> Column:
    """Hash bucket of every one of ``tokens`` (an array column)."""
    return F.transform(tokens, lambda t: tx.hash_bucket(t, dims))


def _dense_from_buckets(buckets: pa.Array, dims: int) -> np.ndarray:
    """Arrow list<int> of token buckets -> L2-normalised (rows, dims) counts:
    one bincount over (row * dims + bucket) for the whole batch."""
    if isinstance(buckets, pa.ChunkedArray):
        buckets = buckets.combine_chunks()
    n = len(buckets)
    lens = pc.fill_null(pc.list_value_length(buckets), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(buckets).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(n, dtype=np.int64), lens)
    out = np.bincount(rows * dims + flat, minlength=n * dims).astype(np.float64).reshape(n, dims)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    np.divide(out, norm, out=out, where=norm > 0)
    return out


def _densify_fn(dims: int):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def densify(buckets: pa.Array) -> pa.Array:
        out = _dense_from_buckets(buckets, dims)
        offsets = pa.array(np.arange(0, (len(out) + 1) * dims, dims, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
    return densify


def hashed_buckets(df: DataFrame, text_col: str, out_col: str = "buckets", dims: int = C.HASH_DIMS) -> DataFrame:
    """Sparse form of the hashed embedding: the bucket of every token
    (JVM-side); :func:`topk_exact` densifies it inside its scoring task."""
    return spread(df).withColumn(out_col, token_buckets(F.col(text_col), dims))


def embed_hashed(df: DataFrame, text_col: str, out_col: str = "embedding", dims: int = C.HASH_DIMS) -> DataFrame:
    """Default embedder: L2-normalised hashed term counts.

    Tokenising and md5 bucketing run in the JVM; one Arrow-batched pandas UDF
    turns the bucket list into the dense normalised vector (np.add.at over the
    whole batch). Any model can replace it through :func:`embed_with`.
    """
    return spread(df).withColumn(out_col, _densify_fn(dims)(token_buckets(F.col(text_col), dims)))


def embed_with(df: DataFrame, text_col: str, factory: Callable, dims: int, out_col: str = "embedding") -> DataFrame:
    """Pluggable embedder hook (L1): ``factory()`` gives ``embedder(list[str]) ->
    ndarray (n, dims)``, built once a Python worker and called once per Arrow batch;
    output rows are L2-normalised."""
    model = once_a_worker(factory)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embedder = model()
        for texts in batches:
            m = np.asarray(embedder(texts.fillna("").tolist()), dtype=np.float64).reshape(len(texts), dims)
            norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
            np.divide(m, norm, out=m, where=norm > 0)
            yield pd.Series(list(m))

    return df.withColumn(out_col, run(F.col(text_col)))


def l2_normalize(col: Column) -> Column:
    """Native L2 normalisation of an array column, in double (I4)."""
    d = F.transform(col, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm)).otherwise(d)


def centroids(vectors: DataFrame, key: str, vec_col: str = "embedding", out_col: str = "qvec") -> DataFrame:
    """Normalised mean vector per ``key`` (one running mean per key and map task)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>"))))
    return vectors.groupBy(key).agg(mean.alias("_m")).select(key, l2_normalize(F.col("_m")).alias(out_col))


# ---------------------------------------------------------------------------
# Exact top-k
# ---------------------------------------------------------------------------

def _matrix(col: pa.Array) -> np.ndarray:
    """List column of equal-length vectors -> (rows, dims) float64 matrix,
    straight from the Arrow buffers."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if n == 0:
        return flat.reshape(0, 0)
    if len(flat) % n:
        raise ValueError("vectors of unequal length")
    return flat.reshape(n, len(flat) // n)


def _slices(batch: pa.RecordBatch, list_col: str) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``SLICE_ROWS`` rows and ``SLICE_ENTRIES`` list entries, one row at least."""
    entries = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(list_col)), 0).to_numpy(zero_copy_only=False))
    i = 0
    while i < batch.num_rows:
        most = (entries[i - 1] if i else 0) + SLICE_ENTRIES
        j = max(min(int(np.searchsorted(entries, most, "right")), i + SLICE_ROWS), i + 1)
        yield batch.slice(i, j - i)
        i = j


def _local_topk_fn(ref, k: int, id_col: str, vec_col: str, bucket_dims: int | None = None):
    """Per-partition scorer (mapInArrow): running top-k per query; however many
    rows tie, it holds and emits a small multiple of k rows per query."""

    def fn(batches):
        q_ids, q_mat = ref.value
        best_ids = [None for _ in q_ids]
        best_sc = [np.empty(0, dtype=np.float64) for _ in q_ids]
        id_type = None
        for rb in batches:
            if rb.num_rows == 0:
                continue
            id_type = rb.schema.field(id_col).type
            for part in _slices(rb, vec_col):
                ids = part.column(id_col).to_numpy(zero_copy_only=False)
                col = part.column(vec_col)
                mat = _dense_from_buckets(col, bucket_dims) if bucket_dims else _matrix(col)
                scores = mat @ q_mat.T                                    # (rows, queries)
                for j in range(len(q_ids)):
                    cand_s = np.concatenate([best_sc[j], scores[:, j]])
                    cand_i = ids if best_ids[j] is None else np.concatenate([best_ids[j], ids])
                    keep = bounded_topk(cand_s, cand_i, k, SCORE_DP)
                    best_sc[j], best_ids[j] = cand_s[keep], cand_i[keep]
        rows_q, rows_i, rows_s = [], [], []
        for j, qid in enumerate(q_ids):
            if best_ids[j] is None:
                continue
            rows_q.append(np.full(len(best_ids[j]), qid, dtype=np.int64))
            rows_i.append(best_ids[j])
            rows_s.append(best_sc[j])
        if rows_q:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(rows_q)), pa.array(np.concatenate(rows_i), type=id_type),
                 pa.array(np.concatenate(rows_s))], names=["query_id", id_col, "raw_score"])

    return fn


def _side_blocks(queries: DataFrame, qid: str, qvec: str, max_side_bytes: int, dims: int | None = None, extra_bytes: int = 0):
    """Yield query blocks as numpy arrays, each within ``max_side_bytes``, where a query
    takes its vector and ``extra_bytes`` (what a task holds for it).

    The count (and, unless ``dims`` is known, the dimension) is measured
    first; if the whole query set is too large it is split by hash of the
    query id into enough blocks to fit. A plain count prunes the vector
    column, so it does not run the embedder.
    """
    if dims:
        n, d = queries.count(), dims
    else:
        stats = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(qvec)).alias("d")).first()
        n, d = int(stats["n"] or 0), int(stats["d"] or 0)
    if n == 0:
        return
    n_blocks = max(1, math.ceil(n * (max(d, 1) * 8 * 2 + extra_bytes) / max_side_bytes))
    for b in range(n_blocks):
        part = queries if n_blocks == 1 else queries.where(F.pmod(F.xxhash64(F.col(qid)), F.lit(n_blocks)) == b)
        rows = part.select(F.col(qid).cast("long").alias("q"), F.col(qvec).alias("v")).toPandas()
        if rows.empty:
            continue
        yield rows["q"].to_numpy(dtype=np.int64), np.stack(rows["v"].to_numpy()).astype(np.float64)


def topk_exact(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = C.TOPK_RETRIEVE,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    qid: str = "query_id",
    qvec: str = "qvec",
    where: Column | None = None,
    max_side_bytes: int = MAX_SIDE_BYTES,
    bucket_dims: int | None = None,
) -> DataFrame:
    """Top-k vectors per query by dot product (= cosine on unit vectors).

    With ``bucket_dims`` the vector column holds hashed-token buckets
    (:func:`token_buckets`) and is densified inside the scoring task, so the
    dense matrix never travels between the JVM and Python.

    Output: ``query_id, <id_col>, score (rounded), rank``. ``where`` is applied
    to the vector table *before* scoring (payload filter, B15/S15) so it is
    pushed into the Parquet scan.
    """
    k = k or C.TOPK_RETRIEVE
    spark = vectors.sparkSession
    vec = vectors if where is None else vectors.where(where)
    vec = spread(vec.select(id_col, vec_col))
    id_type = vectors.schema[id_col].dataType
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField(id_col, id_type),
                           T.StructField("raw_score", T.DoubleType())])
    parts: list[DataFrame] = []
    held = None
    for q_ids, q_mat in _side_blocks(queries, qid, qvec, max_side_bytes, dims=bucket_dims, extra_bytes=32 * k):
        if held is not None:  # another block follows: the one before is answered now, and its queries let go
            parts.append(written(held, "topk_block"))
            ref.destroy()
        ref = spark.sparkContext.broadcast((q_ids, q_mat))
        local = vec.mapInArrow(_local_topk_fn(ref, k, id_col, vec_col, bucket_dims), schema)
        held = rank_topk(local.withColumn("score", F.round("raw_score", SCORE_DP)).drop("raw_score"), k, "query_id", id_col)
    if held is None:
        return spark.createDataFrame([], T.StructType([T.StructField("query_id", T.LongType()), T.StructField(id_col, id_type),
                                                       T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]))
    for p in parts:
        held = held.unionByName(p)
    return held


def rank_topk(scored: DataFrame, k: int, qid: str, id_col: str, score: str = "score") -> DataFrame:
    """Global top-k per query: ``row_number() <= k`` (WindowGroupLimit)."""
    w = Window.partitionBy(qid).orderBy(F.col(score).desc(), F.col(id_col).asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
