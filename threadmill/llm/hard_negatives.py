"""Hard negatives mined with an STR-packed R-tree.

Rows (vec_id, label, v) are packed by sort-tile-recursive: sorted by one
coordinate, cut into slabs, each slab sorted by the next coordinate and cut
again. The upper tree is cut from a bounded sample (``SAMPLE`` rows): first by
label, then by the coordinates of the greatest variance, into ``TILES`` tiles at
most. Every row goes to its tile; a tile is dealt into blocks of about ``ROWS``
rows, so a vector or label that a third of all rows share is many blocks. Each
block packs its own tree: leaves of ``LEAF`` rows of one label, ``FANOUT`` nodes a
parent, a minimum bounding box and a label range each.

A box [lo, hi] bounds the inner product with an anchor a coordinate by
coordinate: between the sums of min(a lo, a hi) and of max(a lo, a hi). A search
takes boxes from a queue, highest upper bound first, and drops a box whose
interval lies outside the score window, whose labels cannot fit, or whose upper
bound is strictly below the k-th score found; it ends when the first box of the
queue is below what every window still needs. Equal scores are thus all seen.

Four rounds: the ``positives`` best rows of the anchor's label, then, for each
of them, the ``negatives`` best rows of other labels whose score lies in its
window; each first in the ``FIRST`` most promising tiles, then in all tiles that the
scores so far do not strike out. A round compares blocks of at most ``QUERIES``
anchors with blocks of rows. Only tile bounds (``TILES`` boxes) are broadcast. The
work still grows as anchors times rows where boxes overlap, as they do in
many dimensions; the answer is exact either way.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; shorter vectors count as padded with zeros; rows equal
in id, label and vector are one row; of rows that repeat an anchor's id the
smallest (label, vector) is the anchor, and none of them is a candidate of it;
a negative positive score has an empty window; equal scores go to the smaller
id; with fewer rows all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import stored

SAMPLE, TILES, ROWS, QUERIES = 4096, 256, 4096, 1024
LEAF, FANOUT = 64, 8
#: Coordinates that a packing sorts by, after the label.
LEVELS = 3
#: Tiles visited in the first of two rounds.
FIRST = 2
#: Below this doubles hold sums of integer products exactly.
EXACT = 2**53


def dense(lists, dim: int) -> np.ndarray:
    """An Arrow column of integer lists as rows of doubles, padded with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dim))
    starts = np.cumsum(n) - n
    column = np.arange(n.sum()) - np.repeat(starts, n)
    out[np.repeat(np.arange(len(n)), n), column] = lists.flatten().to_numpy()
    return out


def _spread(x: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """The coordinates of the greatest variance."""
    return np.argsort(-x.var(axis=0), kind="stable")[:levels] if len(x) else np.zeros(0, np.int64)


def _slab(rows: int, page: int, levels: int) -> int:
    """Rows of a slab when ``levels`` coordinates are left to cut by."""
    pages = -(-rows // page)
    return -(-pages // math.ceil(pages ** (1 / levels))) * page


def str_order(x: np.ndarray, rows: np.ndarray, coordinates, page: int) -> np.ndarray:
    """``rows`` of ``x`` in sort-tile-recursive order."""
    if not len(coordinates) or len(rows) <= page:
        return rows
    rows = rows[np.argsort(x[rows, coordinates[0]], kind="stable")]
    size = _slab(len(rows), page, len(coordinates))
    return np.concatenate(
        [str_order(x, rows[i : i + size], coordinates[1:], page) for i in range(0, len(rows), size)]
    )


def cut_tiles(x: np.ndarray, coordinates, pages: int) -> list:
    """Nested slabs of a sample: [coordinate, cuts, slabs], about ``pages`` leaves;
    a leaf is its tile's number. Column 0 of ``x`` is the label."""
    count = 0

    def cut(rows, left, pages):
        nonlocal count
        if not len(left) or pages <= 1 or len(rows) <= 1:
            count += 1
            return count - 1
        # the label takes half of all cuts, the coordinates share the rest
        slabs = math.ceil(pages ** (0.5 if left[0] == 0 else 1 / len(left)))
        column = np.sort(x[rows, left[0]])
        cuts = np.unique(column[[len(column) * i // slabs for i in range(1, slabs)]])
        cuts = cuts[cuts > column[0]]
        which = np.searchsorted(cuts, x[rows, left[0]], "right")
        return [left[0], cuts, [cut(rows[which == i], left[1:], -(-pages // slabs)) for i in range(len(cuts) + 1)]]

    return cut(np.arange(len(x)), list(coordinates), pages)


def tile_of(x: np.ndarray, node, rows=None, out=None) -> np.ndarray:
    """The tile of every row of ``x`` in the nested slabs ``node``."""
    if rows is None:
        rows, out = np.arange(len(x)), np.zeros(len(x), np.int64)
    if not isinstance(node, list):
        out[rows] = node
        return out
    coordinate, cuts, slabs = node
    which = np.searchsorted(cuts, x[rows, coordinate], "right")
    for i, slab in enumerate(slabs):
        tile_of(x, slab, rows[which == i], out)
    return out


def _labelled(batch, dim: int) -> np.ndarray:
    label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
    return np.concatenate((label[:, None], dense(batch.column("v"), dim)), 1)


def _tiled(ref):
    def run(batches):
        node, dim = ref.value
        for b in batches:
            yield b.append_column("tile", pa.array(tile_of(_labelled(b, dim), node)))

    return run


def _boxes(dim: int):
    """The box of each tile among the rows of a task: label, then coordinates."""

    def run(batches):
        lo, hi, n = {}, {}, {}
        for b in batches:
            x, tile = _labelled(b, dim), b.column("tile").to_numpy()
            for t in np.unique(tile):
                mine = x[tile == t]
                lo[t] = np.minimum(lo.get(t, np.inf), mine.min(0))
                hi[t] = np.maximum(hi.get(t, -np.inf), mine.max(0))
                n[t] = n.get(t, 0) + len(mine)
        if lo:
            cols = [list(n), list(n.values()), [x.tolist() for x in lo.values()], [x.tolist() for x in hi.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["tile", "n", "lo", "hi"])

    return run


def intervals(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least, most = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
    size = np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T
    slack = np.where(size < EXACT, 0.0, 1e-9 * size)
    return least - slack, most + slack


class Tree:
    """An R-tree over some rows: nodes as arrays, leaves first."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, x: np.ndarray):
        order, leaves = [], []
        for one in np.unique(label):
            rows = np.flatnonzero(label == one)
            rows = rows[np.argsort(ids[rows], kind="stable")]
            at = sum(map(len, order))
            order.append(str_order(x, rows, _spread(x[rows]), LEAF))
            leaves += [(at + i, at + min(i + LEAF, len(rows))) for i in range(0, len(rows), LEAF)]
        order = np.concatenate(order)
        self.ids, self.label, self.x = ids[order], label[order], x[order]
        starts = np.array([a for a, _ in leaves])
        lo, hi = [np.minimum.reduceat(self.x, starts)], [np.maximum.reduceat(self.x, starts)]
        first, last = [self.label[starts]], [self.label[[b - 1 for _, b in leaves]]]
        self.leaves, self.children = leaves, [None] * len(leaves)
        base = 0
        while len(lo[-1]) > 1:
            cuts = np.arange(0, len(lo[-1]), FANOUT)
            ends = np.append(cuts[1:], len(lo[-1]))
            self.children += [range(base + a, base + b) for a, b in zip(cuts, ends)]
            base += len(lo[-1])
            lo.append(np.minimum.reduceat(lo[-1], cuts))
            hi.append(np.maximum.reduceat(hi[-1], cuts))
            first.append(first[-1][cuts])
            last.append(last[-1][ends - 1])
        self.lo, self.hi = np.concatenate(lo), np.concatenate(hi)
        self.first, self.last = np.concatenate(first), np.concatenate(last)
        self.big = np.abs(self.x).max(initial=0)

    def scores(self, a: np.ndarray, start: int, end: int) -> np.ndarray:
        if self.big * np.abs(a).max(initial=0) * len(a) < EXACT:
            return (self.x[start:end] @ a).astype(np.int64)
        exact = [sum(int(p) * int(q) for p, q in zip(a, row)) for row in self.x[start:end]]
        return np.array([max(-(2**63), min(2**63 - 1, s)) for s in exact], np.int64)

    def search(self, a, least, most, own: int, label: int, same: bool, windows: list, k: int):
        """For each window (low, high, floor) the k best (score, id) within it that
        are not below its floor; also the number of leaves read."""
        fits = (self.first <= label) & (label <= self.last) if same else (self.first != label) | (self.last != label)
        root = len(self.children) - 1
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        need = np.array([max(low, floor) for low, _, floor in windows], np.int64)
        high = np.array([top for _, top, _ in windows], np.int64)
        queue = [(-most[root], root)]
        read = 0
        while queue:
            top, node = heapq.heappop(queue)
            open_ = need <= -top
            if not open_.any():
                break  # every box left is strictly below what each window needs
            if least[node] > high[open_].max():
                continue
            if self.children[node] is not None:
                low = need[open_].min()
                for child in self.children[node]:
                    if fits[child] and most[child] >= low:
                        heapq.heappush(queue, (-most[child], child))
                continue
            if not fits[node]:
                continue
            start, end = self.leaves[node]
            read += 1
            s, ids = self.scores(a, start, end), self.ids[start:end]
            hits = (s >= need[:, None]) & (s <= high[:, None]) & (ids != own)  # a leaf has one label, which fits
            for i in np.flatnonzero(hits.any(1)):
                s2, i2 = np.append(found[i][0], s[hits[i]]), np.append(found[i][1], ids[hits[i]])
                best = np.lexsort((i2, -s2))[:k]
                found[i] = s2[best], i2[best]
                if len(best) == k:
                    need[i] = max(need[i], s2[best[-1]])
        return found, read


FOUND = "anchor_id long, turn int, vec_id long, score long"


def _block_search(dim: int, k: int, same: bool):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if anchors.num_rows and rows.num_rows:
            tree = Tree(rows["r_vec_id"].to_numpy(), rows["r_label"].to_numpy(), dense(rows["r_v"], dim))
            a = dense(anchors["a_v"], dim)
            least, most = intervals(a, tree.lo, tree.hi)
            ids, labels = anchors["a_anchor_id"].to_pylist(), anchors["a_label"].to_pylist()
            for i, windows in enumerate(anchors["a_windows"].to_pylist()):
                bounds = [(w["low"], w["high"], w["floor"]) for w in windows]
                found, _ = tree.search(a[i], least[i], most[i], ids[i], labels[i], same, bounds, k)
                for w, (s, v) in zip(windows, found):
                    out[0].append(np.full(len(s), ids[i]))
                    out[1].append(np.full(len(s), w["turn"]))
                    out[2].append(v)
                    out[3].append(s)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        cols = [pa.array(np.concatenate(c or [np.zeros(0)]).astype(np.int64)).cast(t) for c, t in zip(out, kinds)]
        return pa.Table.from_arrays(cols, ["anchor_id", "turn", "vec_id", "score"])

    return run


def _due(ref, same: bool, later: bool):
    """(anchor_id, tile): the FIRST most promising tiles of each anchor, or (later)
    the others that may still hold an answer."""

    def run(batches):
        dim, tile, lo, hi = ref.value
        for b in batches:
            label = b.column("label").to_numpy(zero_copy_only=False)
            least, most = intervals(dense(b.column("v"), dim), lo[:, 1:], hi[:, 1:])
            if same:
                fits = (lo[:, 0] <= label[:, None]) & (label[:, None] <= hi[:, 0])
            else:
                fits = (lo[:, 0] != label[:, None]) | (hi[:, 0] != label[:, None])
            due = np.zeros(fits.shape, bool)
            for i, windows in enumerate(b.column("windows").to_pylist()):
                for w in windows:
                    due[i] |= (most[i] >= max(w["low"], w["floor"])) & (least[i] <= w["high"])
            order = np.argsort(np.where(fits, -most, np.inf), axis=1, kind="stable")
            turn = np.empty_like(order)
            np.put_along_axis(turn, order, np.arange(order.shape[1])[None, :], 1)
            due &= fits & ((turn >= FIRST) == later)
            i, t = np.nonzero(due)
            yield pa.RecordBatch.from_arrays(
                [b.column("anchor_id").take(pa.array(i)), pa.array(tile[t])], ["anchor_id", "tile"]
            )

    return run


def _round(anchors, tiled, sizes, ref, dim, k, same, later):
    """The k best rows in each window of the anchors, from the tiles of one round."""
    due = stored(anchors.mapInArrow(_due(ref, same, later), "anchor_id long, tile long"), "due")
    sides = due.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("na")).join(sizes, "tile")
    sides = stored(sides.select("tile", "na", F.ceil(F.col("n") / ROWS).alias("nr")), "sides")
    zero = F.lit(0).cast("long")
    left = (
        due.join(sides, "tile")
        .join(anchors, "anchor_id")
        .withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.col("na")))
        .withColumn("block", F.explode(F.sequence(zero, F.col("nr") - 1)))
        .select("tile", "part", "block", "anchor_id", "label", "v", "windows")
    )
    right = (
        tiled.join(sides, "tile")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("nr")))
        .withColumn("part", F.explode(F.sequence(zero, F.col("na") - 1)))
        .select("tile", "part", "block", "vec_id", "label", "v")
    )
    left, right = left.toDF(*(f"a_{c}" for c in left.columns)), right.toDF(*(f"r_{c}" for c in right.columns))
    return (
        left.groupBy("a_tile", "a_part", "a_block")
        .cogroup(right.groupBy("r_tile", "r_part", "r_block"))
        .applyInArrow(_block_search(dim, k, same), FOUND)
    )


def _two_rounds(anchors, tiled, sizes, ref, dim, k, same):
    """(anchor_id, turn, vec_id, score, rank): the k best rows in each window."""
    best = Window.partitionBy("anchor_id", "turn").orderBy(F.desc("score"), "vec_id")

    def ranked(found, name):
        return stored(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), name)

    found = ranked(_round(anchors, tiled, sizes, ref, dim, k, same, later=False), "first_found")
    kth = found.where(F.col("rank") == k).groupBy("anchor_id").agg(
        F.map_from_entries(F.collect_list(F.struct("turn", "score"))).alias("kth")  # one entry a window
    )
    raised = F.transform(
        "windows",
        lambda w: F.struct(
            w["turn"].alias("turn"), w["low"].alias("low"), w["high"].alias("high"),
            F.coalesce(F.element_at("kth", w["turn"]), w["floor"]).alias("floor"),
        ),
    )
    raised = F.when(F.col("kth").isNull(), F.col("windows")).otherwise(raised)
    anchors = stored(anchors.join(kth, "anchor_id", "left").withColumn("windows", raised).drop("kth"), "raised")
    more = _round(anchors, tiled, sizes, ref, dim, k, same, later=True)
    return ranked(more.union(found.drop("rank")), "found")


def labelled_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v): each component x as floor(scale * x); unusable rows left out."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull())
        .where(finite)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        )
    )


def mine_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each of the ``positives`` best rows of an anchor's label, the ``negatives``
    best rows of other labels that score ``low`` to ``high`` percent of it. Both
    inputs hold (vec_id, label, v) with integer labels and components."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "v").dropna()
    rows = stored(rows.distinct(), "vectors")
    dim, total = rows.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    if dim is None:
        names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], names)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "v").limit(SAMPLE).toArrow()
    x = _labelled(sample, dim)
    node = cut_tiles(x, [0, *(1 + _spread(x[:, 1:]))], min(TILES, -(-total // ROWS)))
    cuts = sc.broadcast((node, dim))
    tiled = stored(rows.mapInArrow(_tiled(cuts), "vec_id long, label long, v array<long>, tile long"), "tiles")
    boxes = tiled.mapInArrow(_boxes(dim), "tile long, n long, lo array<double>, hi array<double>")
    sizes = stored(boxes.groupBy("tile").agg(F.sum("n").alias("n")), "tile_sizes")
    sides = boxes.select("tile", F.posexplode(F.arrays_zip("lo", "hi")).alias("at", "side")).groupBy("tile", "at")
    sides = sides.agg(F.min("side.lo").alias("lo"), F.max("side.hi").alias("hi")).orderBy("tile", "at").toArrow()
    shape = (-1, dim + 1)  # one box a tile
    lo, hi = sides["lo"].to_numpy().reshape(shape), sides["hi"].to_numpy().reshape(shape)
    ref = sc.broadcast((dim, sides["tile"].to_numpy().reshape(shape)[:, 0], lo, hi))
    one = anchors.select(F.col("vec_id").alias("anchor_id"), F.col("label").cast("long").alias("label"), "v").dropna()
    one = one.groupBy("anchor_id").agg(F.min(F.struct("label", "v")).alias("a")).select("anchor_id", "a.label", "a.v")
    one = stored(one, "anchors")
    window = "array<struct<turn:int,low:long,high:long,floor:long>>"
    everything = F.array(
        F.struct(F.lit(0).alias("turn"), F.lit(-(2**63)).alias("low"), F.lit(2**63 - 1).alias("high"), F.lit(-(2**63)).alias("floor"))
    ).cast(window)
    best = _two_rounds(one.withColumn("windows", everything), tiled, sizes, ref, dim, positives, True)
    best = best.select("anchor_id", F.col("rank").alias("turn"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    s = F.col("positive_score").cast("decimal(38,0)")
    at_least, at_most = F.ceil(s * low / 100).cast("long"), F.floor(s * high / 100).cast("long")
    windows = best.where(at_least <= at_most).groupBy("anchor_id").agg(  # ``positives`` windows at most
        F.sort_array(F.collect_list(F.struct("turn", at_least.alias("low"), at_most.alias("high"), F.lit(-(2**63)).alias("floor"))))
        .cast(window).alias("windows")
    )
    searched = stored(one.join(windows, "anchor_id"), "windows")
    found = _two_rounds(searched, tiled, sizes, ref, dim, negatives, False)
    out = found.join(best, ["anchor_id", "turn"])
    cuts.destroy()
    return out.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
