"""Exact top-k by inner product over a pivot-distance index.

Integer vectors get one more coordinate, sqrt(M - |x|^2) with M the largest
squared norm, so that the largest inner product with a query (0 there) is the
smallest Euclidean distance. Pivots are picked farthest-first from a sample of
``SAMPLE`` rows; every row is keyed by its nearest pivot and its distance to
it, and rows of one pivot and distance range form an annulus. By the triangle
inequality no row of an annulus [lo, hi] is nearer to a query at distance d
from the pivot than max(0, d - hi, lo - d). Each query visits annuli in the
order of that bound, in rounds of growing length; after each round its k-th
score so far strikes out annuli whose bound is worse, and the search stops
when none is left. The answer is exact whatever the pivots.

A round compares blocks: the queries of an annulus in blocks of ``Q_BLOCK``
against its rows in blocks of ``ROWS``, so a vector that a third of all rows
share is many blocks, and a block returns k rows a query at most. Annuli are
``PIVOTS`` x ``RINGS`` at most, whatever the input; only their bounds are
broadcast.

Defined results: vectors that are null or hold a null or non-finite component,
and rows with a null id, take no part; shorter vectors count as padded with
zeros; equal scores go to the smaller id; rows equal in id and vector are one
row; of several vectors under a query's id the smallest is the query, and none of
them is a candidate; with fewer candidates all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import stored

SAMPLE, PIVOTS, RINGS = 2048, 32, 8
Q_BLOCK, ROWS = 1024, 4096
#: Annuli visited in each round; the last takes all that are left.
ROUNDS = (1, 6, None)
#: Relative slack of the floating-point bounds.
SLACK = 1e-9


def _matrix(lists, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate((x, np.sqrt(np.maximum(top - (x * x).sum(1), 0.0))[:, None]), 1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(d, 0.0))


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first rows of the sample."""
    take = [0]
    near = _distances(sample, sample[:1])[:, 0]
    while len(take) < min(n, len(sample)) and near.max() > 0:
        take.append(int(near.argmax()))
        near = np.minimum(near, _distances(sample, sample[take[-1:]])[:, 0])
    return sample[take]


def _keyed(ref):
    def run(batches):
        pivots, dim, top, width = ref.value
        for b in batches:
            x = _augmented(_matrix(b.column("v").to_pylist(), dim), top)
            d = _distances(x, pivots)
            p = d.argmin(1)
            r = d[np.arange(len(x)), p]
            ring = np.minimum((r / width).astype(np.int64), RINGS - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array(p * RINGS + ring), pa.array(r)],
                ["vec_id", "v", "annulus", "r"],
            )

    return run


def _visits(ref):
    """(query_id, annulus, bound) of every query: the best score the annulus can hold."""

    def run(batches):
        pivots, dim, top, annulus, lo, hi = ref.value
        for b in batches:
            x = _matrix(b.column("v").to_pylist(), dim)
            q = np.concatenate((x, np.zeros((len(x), 1))), 1)
            d = _distances(q, pivots)[:, annulus // RINGS]
            pad = SLACK * (d + hi[None, :] + 1.0)
            gap = np.maximum(np.maximum(d - hi[None, :], lo[None, :] - d) - pad, 0.0)
            norm = (x * x).sum(1)[:, None]
            bound = (norm + top - gap * gap) / 2
            bound += SLACK * (np.abs(bound) + norm + top) + 1.0
            n, m = bound.shape
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(b.column("vec_id").to_numpy(), m)),
                    pa.array(np.tile(annulus, n)),
                    pa.array(bound.ravel()),
                ],
                ["query_id", "annulus", "bound"],
            )

    return run


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact while they fit a long."""
    if not len(q) or not len(x) or np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2**53:
        return (q @ x.T).astype(np.int64)
    exact = q.astype(object).dot(x.T.astype(object))
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(k: int, dim: int):
    def run(key, queries, rows):
        cols = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(rows):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in cols})
        rows = rows.sort_values("r_vec_id", kind="stable")
        ids, qid = rows["r_vec_id"].to_numpy(), queries["q_query_id"].to_numpy()
        s = _scores(_matrix(queries["q_v"], dim), _matrix(rows["r_v"], dim))
        own = qid[:, None] == ids[None, :]
        # stable order: equal scores keep the order of ids; rows of the query's own id come last
        best_first = -s.astype(np.float64) if np.abs(s).max() < 2**53 else -s.astype(object)
        best_first[own] = 2**70
        order = np.argsort(best_first, axis=1, kind="stable")[:, :k]
        i = np.repeat(np.arange(len(qid)), order.shape[1])
        j = order.ravel()
        keep = ~own[i, j]
        return pd.DataFrame({"query_id": qid[i[keep]], "vec_id": ids[j[keep]], "score": s[i[keep], j[keep]]})

    return run


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): each component x as floor(scale * x); unusable rows left out."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & v.isNotNull())
        .where(finite)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
        .dropDuplicates(["vec_id", "v"])
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` (vec_id, v)
    for each row of ``queries`` (vec_id, v), one query an id."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    dim, top = vectors.agg(F.max(F.size("v")), F.max(size)).first()
    if dim is None:
        return empty
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample = _augmented(_matrix([r.v for r in sample], dim), top)
    pivots = pick_pivots(sample, PIVOTS)
    width = float(_distances(sample, pivots).min(1).max()) * 1.25 / RINGS or 1.0
    sc = spark.sparkContext
    keyed = stored(
        vectors.mapInArrow(_keyed(sc.broadcast((pivots, dim, top, width))), "vec_id long, v array<long>, annulus long, r double"),
        "annuli",
    )
    bounds = keyed.groupBy("annulus").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count(F.lit(1)).alias("n"))
    bounds = stored(bounds, "annulus_bounds")
    got = bounds.orderBy("annulus").collect()  # PIVOTS x RINGS rows at most
    ref = sc.broadcast((pivots, dim, top, *(np.array([r[c] for r in got]) for c in ("annulus", "lo", "hi"))))
    one = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    one = stored(one, "queries")
    visits = one.mapInArrow(_visits(ref), "query_id long, annulus long, bound double")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "annulus")
    visits = stored(visits.withColumn("turn", F.row_number().over(by_bound)), "visits")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found, after = None, 0
    for length in ROUNDS:
        due = visits.where(F.col("turn") > after)
        if length is not None:
            due = due.where(F.col("turn") <= after + length)
            after += length
        if found is not None:
            kth = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
            due = due.join(kth, "query_id", "left").where(f"n is null or n < {k} or bound >= kth")
        due = stored(due.select("query_id", "annulus"), "due")
        if due.isEmpty():
            break
        sides = due.groupBy("annulus").agg(F.ceil(F.count(F.lit(1)) / Q_BLOCK).alias("nq")).join(bounds, "annulus")
        sides = stored(sides.select("annulus", "nq", F.ceil(F.col("n") / ROWS).alias("nr")), "sides")
        zero = F.lit(0).cast("long")
        left = (
            due.join(sides, "annulus")
            .join(one.withColumnRenamed("vec_id", "query_id"), "query_id")
            .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("nq")))
            .withColumn("rb", F.explode(F.sequence(zero, F.col("nr") - 1)))
            .select("annulus", "qb", "rb", "query_id", "v")
        )
        right = (
            keyed.join(sides, "annulus")
            .withColumn("rb", F.pmod(F.xxhash64("vec_id"), F.col("nr")))
            .withColumn("qb", F.explode(F.sequence(zero, F.col("nq") - 1)))
            .select("annulus", "qb", "rb", "vec_id", "v")
        )
        left, right = left.toDF(*(f"q_{c}" for c in left.columns)), right.toDF(*(f"r_{c}" for c in right.columns))
        more = (
            left.groupBy("q_annulus", "q_qb", "q_rb")
            .cogroup(right.groupBy("r_annulus", "r_qb", "r_rb"))
            .applyInPandas(_best(k, dim), "query_id long, vec_id long, score long")
        )
        more = more if found is None else found.select("query_id", "vec_id", "score").union(more)
        found = stored(more.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k), "found")
    if found is None:
        return empty
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
