"""Quality rules: exact base rules, then an isolation forest on rule statistics.

Base rules fail a document with fewer than 50 words, or with more than half of
its words in 3-word windows that come up twice or more. The forest is fitted on
statistics of clean labelled rows; random splits reach ``MARGIN`` standard
deviations (of all labelled rows) beyond the values at hand, so a document
unlike them ends in an empty leaf near the root. A document
whose mean path is short (anomaly score above a threshold) is rejected; the
threshold is calibrated on labelled rows that pass the base rules: all but
``CLEAN_LOSS`` of the clean ones stay below it, and where the other ones lie
higher it is the middle of the gap.

Every labelled row takes part: each clean one is dealt by a hash to the trees it
teaches, one at least, and more while a tree has fewer than ``PER_TREE`` rows. Trees grow a level at a
time: Spark counts the rows of every node and their ranges, and the driver draws the
splits, so it holds nodes and no rows. The threshold comes from the scores of all
labelled rows, counted in steps of 1 / ``STEPS``. Statistics and verdicts cover every
document and whole texts, in one scan of the texts that ``judge_quality`` keeps as narrow rows;
the forest is a few megabytes whatever the input.

Defined results: null and empty texts have no words and fail the base rules;
labels that are null, or without a document, teach nothing; without clean
labelled rows the forest rejects nothing; repeated rows get the same verdict;
of rows that repeat a doc_id the one of the smallest statistics teaches;
extra columns pass through ``keep_quality`` unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.llm.common import POWERS, Prefix, Words, documents, mix, slices, starts_of, stored, text_bytes

#: TREES is a power of two.
TREES, PER_TREE, DEPTH, MARGIN = 128, 256, 10, 0.5
STEPS = 100_000
CLEAN_LOSS = 0.001
MIN_WORDS, REPEAT_PERCENT = 50, 50

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = 4
MEASURED = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, f array<double>"
NODES = "tree int, node int, n long, " + ", ".join(f"lo{i} double, hi{i} double" for i in range(FEATURES))


def statistics(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """Counts of each text: those of the contract, and two more for the forest."""
    w = Words(texts)
    buf = np.frombuffer(w.joined, np.uint8)
    ends = w.offsets[1:]

    def per_text(flags: np.ndarray) -> np.ndarray:
        c = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=c[1:])
        return c[ends] - c[w.offsets[:-1]]

    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    out = {
        "n_words": w.counts.astype(np.int64),
        "word_chars": per_text(~blank & ((buf & 0xC0) != 0x80)),
        "n_symbols": per_text(SYMBOL[buf]),
    }
    dup, lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            own = [x for x in t.split(b"\n") if x.strip()]
            lines[i], dup[i] = len(own), len(own) - len(set(own))
    out["n_dup_lines"], out["n_lines"] = dup, lines

    per = np.maximum(w.counts - 2, 0)
    doc = np.repeat(np.arange(len(per)), per)
    at = np.arange(per.sum()) - np.repeat(starts_of(per)[:-1], per) + w.first[:-1][doc]
    key = Prefix(w.hashes, POWERS).of(at, at + 3) ^ mix(doc.astype(np.uint64) + np.uint64(1))
    _, inv, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = times[inv] > 1
    n = len(w.hashes)
    edge = np.bincount(at[twice], minlength=n + 1) - np.bincount(at[twice] + 3, minlength=n + 1)
    repeated = starts_of(np.cumsum(edge)[:n] > 0)
    out["n_repeat_words"] = repeated[w.first[1:]] - repeated[w.first[:-1]]
    owner = np.repeat(np.arange(len(texts)), w.counts).astype(np.uint64)
    distinct = np.unique(w.hashes ^ mix(owner + np.uint64(1)), return_index=True)[1]
    out["n_distinct"] = np.bincount(owner[distinct].astype(np.int64), minlength=len(texts)).astype(np.int64)
    return out


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """One row of rule ratios for each text; words in repeated windows and repeated
    lines do not count as varied."""
    words = np.maximum(s["n_words"], 1).astype(float)
    fresh_lines = np.maximum(s["n_lines"] - s["n_dup_lines"], 1).astype(float)
    fresh = 1 - s["n_repeat_words"] / words
    return np.stack(
        [
            s["word_chars"] / words,
            s["n_symbols"] / words,
            np.log(words / fresh_lines),
            (s["n_distinct"] / words) * fresh * np.log1p(words),
        ],
        1,
    )


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > REPEAT_PERCENT * s["n_words"])


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees as arrays [tree, node]; children of node i are 2i+1 and 2i+2."""

    def __init__(self, pad: np.ndarray, per_tree: float):
        self.pad = pad
        size = 2 ** (DEPTH + 1) - 1
        self.feature = np.full((TREES, size), -1, np.int16)
        self.split = np.zeros((TREES, size))
        self.length = np.tile(np.floor(np.log2(np.arange(size) + 1)), (TREES, 1))  # of an empty leaf: its depth
        self.norm = max(float(_mean_path(per_tree)), 1e-9)
        self.threshold = np.inf

    def grow(self, level: int, tree: np.ndarray, node: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: int = 7) -> bool:
        """Split the nodes of a level that hold ``n`` rows within ``lo`` and ``hi``; False if none is split."""
        lo, hi = lo - self.pad, hi + self.pad
        wide = hi > lo
        cut = wide.any(1) & (n >= 2) & (level < DEPTH) & bool(self.pad.any())
        self.length[tree[~cut], node[~cut]] += _mean_path(n[~cut])
        tree, node, lo, hi, wide = tree[cut], node[cut], lo[cut], hi[cut], wide[cut]
        drawn = np.random.default_rng([seed, level]).random((TREES, 2**level, 2))[tree, node - (2**level - 1)]
        nth = np.floor(drawn[:, 0] * wide.sum(1))
        f = np.argmax(np.cumsum(wide, 1) > nth[:, None], 1)
        at = np.arange(len(f))
        self.feature[tree, node] = f
        self.split[tree, node] = lo[at, f] + drawn[:, 1] * (hi[at, f] - lo[at, f])
        return bool(len(f))

    def place(self, x: np.ndarray, tree: np.ndarray) -> np.ndarray:
        """Node in which each row ends in its tree."""
        node = np.zeros(tree.shape, np.int64)
        rows = np.arange(len(x)).reshape(-1, *[1] * (tree.ndim - 1))
        for _ in range(DEPTH):
            f = self.feature[tree, node]
            node = np.where(f >= 0, 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= self.split[tree, node]), node)
        return node

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1; about 0.5 for rows like the clean ones."""
        tree = np.broadcast_to(np.arange(TREES), (len(x), TREES))
        return 2.0 ** (-self.length[tree, self.place(x, tree)].mean(1) / self.norm)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def _measure(batches):
    for b in batches:
        texts = text_bytes(b)
        for x, y in slices(texts):
            s = statistics(texts[x:y])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").slice(x, y - x),
                    *(pa.array(s[c], pa.int64()) for c in COUNTS),
                    pa.array(base_failed(s)),
                    pa.array(list(features(s)), pa.list_(pa.float64())),
                ],
                ["doc_id", *COUNTS, "base_failed", "f"],
            )


def _measured(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, f) of every row of ``docs``: narrow rows without text."""
    return documents(docs).mapInArrow(_measure, MEASURED)


def _node_ranges(forest_ref, level: int, copies: int):
    """Rows and ranges of the nodes of a level, by batch."""

    def run(batches):
        forest = forest_ref.value
        size = forest.feature.shape[1]
        for b in batches:
            if not b.num_rows:
                continue
            x, h = _rows(b), b.column("h").to_numpy().view(np.uint64)
            step = (h >> np.uint64(32)) | np.uint64(1)  # odd, so the trees of a row differ
            tree = ((h[:, None] + step[:, None] * np.arange(copies, dtype=np.uint64)) % np.uint64(TREES)).astype(np.int64)
            node = forest.place(x, tree)
            row, col = np.nonzero(node >= 2**level - 1)
            if not len(row):
                continue
            key = tree[row, col] * size + node[row, col]
            order = np.argsort(key, kind="stable")
            key, at = np.unique(key[order], return_index=True)
            x = x[row[order]]
            lo, hi = np.minimum.reduceat(x, at), np.maximum.reduceat(x, at)
            ends = [e for i in range(FEATURES) for e in (pa.array(lo[:, i]), pa.array(hi[:, i]))]
            n = np.diff(np.append(at, len(x)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((key // size).astype(np.int32)), pa.array((key % size).astype(np.int32)), pa.array(n.astype(np.int64)), *ends],
                ["tree", "node", "n", *(f"{e}{i}" for i in range(FEATURES) for e in ("lo", "hi"))],
            )

    return run


def _score_steps(forest_ref):
    def run(batches):
        for b in batches:
            step = np.floor(forest_ref.value.scores(_rows(b)) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("quality"), pa.array(step)], ["quality", "step"])

    return run


def _quantile(steps: list[tuple[int, int]], q: float) -> int:
    """The step that a share ``q`` of the rows of ``steps`` (step, times) does not exceed."""
    left = q * sum(n for _, n in steps)
    for step, n in sorted(steps):
        left -= n
        if left <= 0:
            break
    return step


def fit_forest(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """Forest and threshold from all labelled rows (quality 1: clean)."""
    return _fit(_measured(docs), labels)


def _fit(measured: DataFrame, labels: DataFrame) -> Forest | None:
    spark = measured.sparkSession
    quality = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    # one row a labelled doc_id; rows that pass the base rules come first
    known = measured.join(quality, "doc_id").groupBy("doc_id")
    known = known.agg(F.min(F.struct("base_failed", "f")).alias("s"), F.min("quality").alias("quality")).where("not s.base_failed")
    rows = stored(known.select("quality", F.xxhash64("doc_id").alias("h"), "s.f"), "labelled_statistics")
    wide = [F.stddev_pop(F.col("f")[i]) for i in range(FEATURES)]
    n_clean, *deviations = rows.agg(F.count_if(F.col("quality") == 1), *wide).first()
    if n_clean < 2:
        return None
    copies = min(TREES, -(-PER_TREE * TREES // n_clean))
    # rounded, as sums depend on the order of the tasks in their last digits
    forest = Forest(MARGIN * np.array([float(f"{x:.6g}") for x in deviations]), n_clean * copies / TREES)
    clean = rows.where("quality = 1").select("h", "f")
    ends = [e for i in range(FEATURES) for e in (F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"))]
    for level in range(DEPTH + 1):
        ref = spark.sparkContext.broadcast(forest)
        found = clean.mapInArrow(_node_ranges(ref, level, copies), NODES)
        found = found.groupBy("tree", "node").agg(F.sum("n").alias("n"), *ends).toPandas()  # TREES * 2 ** level rows at most
        ref.unpersist()
        lo, hi = (found[[f"{e}{i}" for i in range(FEATURES)]].to_numpy(float) for e in ("lo", "hi"))
        if not forest.grow(level, *(found[c].to_numpy(np.int64) for c in ("tree", "node", "n")), lo, hi):
            break
    ref = spark.sparkContext.broadcast(forest)
    steps = rows.select("quality", "f").mapInArrow(_score_steps(ref), "quality int, step long").groupBy("quality", "step").count().collect()
    ref.unpersist()
    top = (_quantile([(r.step, r["count"]) for r in steps if r.quality == 1], 1 - CLEAN_LOSS) + 1) / STEPS
    junk = [(r.step, r["count"]) for r in steps if r.quality == 0]
    low = _quantile(junk, 0.01) / STEPS if junk else top
    forest.threshold = max(top, (top + low) / 2)
    return forest


def _kept(texts: list[bytes | None], forest: Forest | None) -> np.ndarray:
    s = statistics(texts)
    failed = base_failed(s)
    return ~failed & (forest.scores(features(s)) <= forest.threshold) if forest else ~failed


def _judge(forest_ref):
    def run(batches):
        forest = forest_ref.value
        for b in batches:
            failed = b.column("base_failed").to_numpy(zero_copy_only=False)
            score = forest.scores(_rows(b)) if forest else np.zeros(b.num_rows)
            kept = ~failed & (score <= forest.threshold if forest else True)
            cols = [b.column(c) for c in ("doc_id", *COUNTS, "base_failed")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(kept), pa.array(score)], ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    return run


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept, anomaly) for every row of ``docs``."""
    measured = stored(_measured(docs), "statistics")
    forest = docs.sparkSession.sparkContext.broadcast(_fit(measured, labels))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"
    return measured.mapInArrow(_judge(forest), schema)


def _filter(forest_ref, text_col: str):
    def run(batches):
        forest = forest_ref.value
        for b in batches:
            texts = text_bytes(b, text_col)
            kept = [_kept(texts[x:y], forest) for x, y in slices(texts)]
            if kept:
                yield b.filter(pa.array(np.concatenate(kept)))

    return run


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are kept."""
    forest = docs.sparkSession.sparkContext.broadcast(fit_forest(docs, labels))
    text_col = next(c for c in docs.columns if c.lower() == "text")
    names = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    at = f"c{docs.columns.index(text_col)}"
    return docs.toDF(*names.names).mapInArrow(_filter(forest, at), names).toDF(*docs.columns)
