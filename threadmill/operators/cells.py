"""Approximate top-k over cells.

Vectors are laid out by the nearest of ``PER_ROOT`` x sqrt(rows) centres (at most
``MAX_CELLS``), which are fitted in two levels on a bounded sample; every row is
indexed. Beside each vector the table holds a one-byte code of every component, a
quarter of the bytes of a float, and a search reads codes, not vectors.

A query probes few cells first, which gives the k-th score so far. From a cell's
centre and spread follows how many of its rows may be expected above that score
(as if residuals were normally distributed); cells are added, those with the most per row
first, until the rows expected in what is left are fewer than ``missed`` x k, in
``ROUNDS`` of growing length, as every round raises the k-th score. So clustered vectors are searched in a few cells, and vectors without clusters in many. The
best ``OVER`` x k rows by code are scored again from their vectors. With ``missed`` = 0
all cells are read and the answer is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import scratch_path
from .components import written
from .layout import spread
from .vectors import MAX_SIDE_BYTES, SCORE_DP, _matrix, _side_blocks, rank_topk

PER_ROOT, MAX_CELLS = 4, 16_384
#: Rows the centres are fitted on: so many a cell, and at most.
SAMPLE_A_CELL, SAMPLE = 64, 65_536
STEPS = 8
#: Share of the rows probed after each round but the last, and the oversampling of the rows scored again.
ROUNDS, OVER = (0.02, 0.15), 4


@dataclass
class CellIndex:
    table: DataFrame  # id, vector, cell, codes, scale; partitioned by coarse
    id_col: str
    vec_col: str
    centres: np.ndarray  # of the cells
    coarse: np.ndarray  # coarse cell of each cell
    rows: np.ndarray  # by cell
    spread: np.ndarray  # by cell, root mean square distance to the centre


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1)[None, :] - 2 * (x @ c.T)).argmin(1)


def _centres(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from distinct rows; a centre that loses its rows stays where it is."""
    rng = np.random.default_rng(seed)
    rows = np.unique(x, axis=0)
    c = rows[rng.choice(len(rows), min(n, len(rows)), replace=False)].copy()
    for _ in range(STEPS):
        near = _nearest(x, c)
        count = np.bincount(near, minlength=len(c))
        order = np.argsort(near, kind="stable")
        starts = np.concatenate(([0], np.cumsum(count)))[:-1][count > 0]
        c[count > 0] = np.add.reduceat(x[order], starts) / count[count > 0][:, None]
    return c


def fit_cells(sample: np.ndarray, cells: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coarse centres, centres of the cells, coarse cell of each)."""
    top = _centres(sample, math.ceil(math.sqrt(cells)), seed)
    near = _nearest(sample, top)
    fine, owner = [], []
    for i in range(len(top)):
        mine = sample[near == i]
        if not len(mine):
            mine = top[i : i + 1]
        c = _centres(mine, max(1, round(cells * len(mine) / len(sample))), seed + i + 1)
        fine.append(c)
        owner.append(np.full(len(c), i))
    return top, np.concatenate(fine), np.concatenate(owner)


def _assigned(ref, vec_col: str):
    """Cell, distance to its centre and byte codes of each vector: the nearest centre below the
    nearest coarse one."""

    def run(batches):
        top, centres, owner = ref.value
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(vec_col))
            near = _nearest(x, top)
            cell = np.zeros(len(x), np.int64)
            for i in np.unique(near):
                mine, own = np.flatnonzero(near == i), np.flatnonzero(owner == i)
                cell[mine] = own[_nearest(x[mine], centres[own])]
            apart = ((x - centres[cell]) ** 2).sum(1)
            scale = np.abs(x).max(1) / 127
            codes = np.rint(x / np.where(scale > 0, scale, 1.0)[:, None]).astype(np.int8)
            more = [pa.array(near.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(apart),
                    pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(scale.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "coarse", "cell", "apart", "codes", "scale"])

    return run


def build_cells(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cells: int | None = None) -> CellIndex:
    """Index of all rows of ``vectors`` with a vector."""
    spark = vectors.sparkSession
    rows = vectors.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col)).where(F.col(vec_col).isNotNull())
    n = rows.count()
    cells = max(1, min(cells or round(PER_ROOT * math.sqrt(n)), MAX_CELLS, n))
    sample = rows.orderBy(F.xxhash64(id_col), id_col).limit(min(SAMPLE_A_CELL * cells, SAMPLE)).select(vec_col).toArrow()
    if not n:
        top = centres = np.zeros((1, 1))
        owner = np.zeros(1, np.int64)
    else:
        top, centres, owner = fit_cells(_matrix(sample[vec_col]), cells)
    ref = spark.sparkContext.broadcast((top, centres, owner))
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("coarse int, cell int, apart double, codes binary, scale float").fields])
    path = scratch_path(spark, "cells")
    laid = spread(rows).mapInArrow(_assigned(ref, vec_col), schema).repartition("coarse").sortWithinPartitions("cell")
    laid.write.partitionBy("coarse").parquet(path)
    ref.destroy()
    table = spark.read.schema(schema).parquet(path)
    stats = table.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.avg("apart").alias("apart")).collect()  # MAX_CELLS rows at most
    held, apart = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in stats:
        held[r.cell], apart[r.cell] = r.n, r.apart
    return CellIndex(table, id_col, vec_col, centres, owner, held, np.sqrt(apart))


def _above(z: np.ndarray) -> np.ndarray:
    """Share of a normal distribution above ``z``."""
    return 0.5 * np.vectorize(math.erfc, otypes=[float])(z / math.sqrt(2))


def cells_due(index: CellIndex, q: np.ndarray, kth: np.ndarray, k: int, missed: float, share: float) -> np.ndarray:
    """[query, cell] flags of the cells worth reading when the k-th score so far is ``kth``
    (-inf: not known), up to ``share`` of the rows (one cell at least)."""
    near = q @ index.centres.T
    sigma = index.spread[None, :] * np.linalg.norm(q, axis=1)[:, None] / math.sqrt(max(q.shape[1], 1)) + 1e-12
    above = np.where(np.isfinite(kth)[:, None], _above((kth[:, None] - near) / sigma), 1.0)
    order = np.stack([np.lexsort((-n, -a)) for n, a in zip(near, above)])
    expected = np.take_along_axis(above * index.rows[None, :], order, 1)
    left = np.cumsum(expected[:, ::-1], axis=1)[:, ::-1]  # in this cell and all after it
    before = np.cumsum(index.rows[order], axis=1) - index.rows[order]
    out = np.zeros(near.shape, bool)
    np.put_along_axis(out, order, (left > missed * k) & (before < max(1, share * index.rows.sum())), axis=1)
    return out


def _coded(ref, k: int, id_col: str):
    """The k best rows a task and query by code, among the cells the query probes."""

    def run(batches):
        q_ids, q, probe = ref.value
        best = [(np.zeros(0), None) for _ in q_ids]
        kind = None
        for b in batches:
            if not b.num_rows:
                continue
            cell = b.column("cell").to_numpy()
            kind = b.column(id_col).type
            ids = b.column(id_col).to_numpy(zero_copy_only=False)
            codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.int8).reshape(b.num_rows, -1)
            s = (codes.astype(np.float32) @ q.T.astype(np.float32)) * b.column("scale").to_numpy()[:, None]
            for j in range(len(q_ids)):
                hit = np.flatnonzero(probe[j][cell])
                if not len(hit):
                    continue
                old, old_ids = best[j]
                score = np.concatenate((old, s[hit, j]))
                names = ids[hit] if old_ids is None else np.concatenate((old_ids, ids[hit]))
                keep = np.lexsort((names, -score))[:k]
                best[j] = score[keep], names[keep]
        found = [(q_ids[j], s, i) for j, (s, i) in enumerate(best) if i is not None]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.full(len(s), x) for x, s, _ in found])), pa.array(np.concatenate([i for *_, i in found]), kind),
                 pa.array(np.concatenate([s for _, s, _ in found]).astype(np.float64))], ["query_id", id_col, "score"])

    return run


def topk_cells(index: CellIndex, queries: DataFrame, k: int = C.TOPK_RETRIEVE, missed: float = 0.08, qid: str = "query_id",
               qvec: str = "qvec", max_side_bytes: int = MAX_SIDE_BYTES, read: list | None = None) -> DataFrame:
    """``query_id, <id>, score, rank``: the ``k`` best rows per query by dot product, less about
    ``missed`` of them. Query blocks that fit ``max_side_bytes`` are answered one after
    another. ``read``, where given, collects the share of all rows whose codes were read."""
    spark = index.table.sparkSession
    schema = T.StructType([T.StructField("query_id", T.LongType()), index.table.schema[index.id_col], T.StructField("score", T.DoubleType())])
    total = max(int(index.rows.sum()), 1)
    out = None
    cells_bytes = len(index.centres) * 8
    blocks = _side_blocks(queries, qid, qvec, max_side_bytes, extra_bytes=cells_bytes + 32 * OVER * k)
    for q_ids, q in blocks if index.rows.any() else ():
        def scan(probe: np.ndarray, name: str) -> DataFrame:
            due = np.flatnonzero(probe.any(0))
            ref = spark.sparkContext.broadcast((q_ids, q, probe))
            rows = index.table.where(F.col("coarse").isin(np.unique(index.coarse[due]).tolist())).select(index.id_col, "cell", "codes", "scale")
            local = rows.mapInArrow(_coded(ref, OVER * k, index.id_col), schema)
            found = written(rank_topk(local, OVER * k, "query_id", index.id_col), name)
            ref.destroy()
            return found

        probe, kth, found = np.zeros((len(q_ids), len(index.centres)), bool), np.full(len(q_ids), -np.inf), None
        for share in (*(ROUNDS if missed > 0 else ()), 1.0):
            due = cells_due(index, q, kth, k, missed, share) & ~probe
            if not due.any():
                continue
            probe |= due
            more = scan(due, "best_codes").drop("rank")
            more = more if found is None else more.unionByName(found.drop("rank"))
            found = written(rank_topk(more, OVER * k, "query_id", index.id_col), "cells_so_far")
            if share < 1.0:
                best = {r.query_id: r.score for r in found.where(F.col("rank") == k).collect()}
                kth = np.array([best.get(i, -np.inf) for i in q_ids.tolist()])
        if read is not None:
            read += (probe @ index.rows / total).tolist()
        found = found.select("query_id", index.id_col)
        # from the vectors themselves; few rows a query
        vec = index.table.where(F.col("coarse").isin(np.unique(index.coarse[probe.any(0)]).tolist())).select(index.id_col, index.vec_col)
        own = queries.select(F.col(qid).cast("long").alias("query_id"), F.col(qvec).cast("array<double>").alias("_q"))
        both = found.join(vec, index.id_col).join(own, "query_id")
        dot = F.aggregate(F.zip_with(index.vec_col, "_q", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        scored = both.select("query_id", index.id_col, F.round(dot, SCORE_DP).alias("score"))
        part = written(rank_topk(scored, k, "query_id", index.id_col), "cell_topk")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("rank", T.IntegerType())]))
    return out
