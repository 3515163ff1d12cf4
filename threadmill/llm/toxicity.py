"""Toxicity by a factorization machine over hashed terms.

Terms are runs of letters, lower-cased, and their first ``PREFIXES`` letters,
hashed into ``BUCKETS`` places. A score adds a bias, a weight for every term
present and, for every pair of terms, the product of two ``RANK``-vectors, so
an insult can weigh more beside a group it is aimed at than either does alone.

Only the fit looks at a sample: ``LABELLED`` labelled doc_ids, in the order of a
hash. Spark counts their terms by label; the ``FEATURES`` places whose shares
differ most (by at least ``LEAST_Z`` standard errors) become features of the
machine. So do the words of the ``PAIRS`` pairs that stand within ``NEAR`` words of
each other and whose shares differ by ``PAIR_Z`` standard errors, though neither
word may differ by itself; both words of a pair stand in ``PAIR_DOCS`` documents
of the sample or more. (Two words that tell nothing alone and never come near each
other are not found.) The rows are collected as feature lists. Scores cover
every document and whole texts in one scan without a shuffle; the model is
bounded by ``FEATURES`` and ``PAIRS`` whatever the input.

Defined results: null and empty texts score the bias, as texts without any
feature do; labels other than 0 and 1 or without a document teach nothing; of
rows that repeat a labelled doc_id the smallest text is learnt from, with the
larger label; without labels, or with one class only, every score is 0; repeated
rows get the same score; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import POWERS, Prefix, documents, mix, slices, starts_of, stored
from threadmill.llm.language_id import letter_table

LABELLED = 20_000
BUCKETS = 1 << 20
PREFIXES = (5, 6, 7, 8)
FEATURES, LEAST_Z, RANK = 4096, 4.0, 6
PAIRS, PAIR_Z, PAIR_DOCS, NEAR = 512, 6.0, 20, 5
EPOCHS, RATE, RIDGE = 300, 0.05, 2e-5


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Prefix]:
    """Begin, end and text of every run of letters in order, and the hashes of their ranges."""
    letters = letter_table()
    joined = [(t or "").lower() + " " for t in texts]
    lens = np.fromiter(map(len, joined), np.int64, len(joined))
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters[codes]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_letter)).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    owner = np.searchsorted(starts_of(lens), begin, side="right") - 1
    return begin, end, owner, Prefix(mix(codes.astype(np.uint64) + np.uint64(1)), POWERS)


def _place(h: np.ndarray, n: int = 0) -> np.ndarray:
    return (mix(h + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def terms(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the distinct term places of each text; with ``wanted``
    (a flag for each place) only of those."""
    begin, end, owner, prefix = _words(texts)
    keys = []
    for n in (None, *PREFIXES):
        some = np.ones(len(begin), bool) if n is None else end - begin >= n
        a = begin[some]
        place = _place(prefix.of(a, end[some] if n is None else a + n), n or 0)
        who = owner[some]
        if wanted is not None:
            hit = wanted[place]
            place, who = place[hit], who[hit]
        keys.append(who * BUCKETS + place)
    both = np.unique(np.concatenate(keys))
    return both // BUCKETS, both % BUCKETS


def pairs(texts: list[str | None], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, smaller place * BUCKETS + larger place) of the distinct pairs of wanted
    words that stand within NEAR words of each other."""
    begin, end, owner, prefix = _words(texts)
    place = _place(prefix.of(begin, end))
    keys, who = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for gap in range(1, NEAR + 1):
        x, y = place[:-gap], place[gap:]
        near = (owner[:-gap] == owner[gap:]) & wanted[x] & wanted[y] & (x != y)
        keys.append(np.minimum(x, y)[near] * BUCKETS + np.maximum(x, y)[near])
        who.append(owner[gap:][near])
    key, who = np.concatenate(keys), np.concatenate(who)
    order = np.lexsort((key, who))
    key, who = key[order], who[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
    return who[new], key[new]


def _by_label(found):
    """Documents of each label that hold each term or pair, counted in the batch."""

    def run(batches):
        for b in batches:
            texts, toxic = b.column("text").to_pylist(), b.column("toxic").to_numpy()
            for x, y in slices(texts):
                who, place = found(texts[x:y])
                one = toxic[x:y][who] == 1
                u, inv = np.unique(place, return_inverse=True)
                pos, neg = (np.bincount(inv, k, len(u)).astype(np.int64) for k in (one, ~one))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(pos), pa.array(neg)], ["place", "pos", "neg"])

    return run


def _pairs_of(ref):
    return lambda texts: pairs(texts, ref.value)


def _feature_rows(ref):
    def run(batches):
        column = ref.value
        for b in batches:
            texts, toxic = b.column("text").to_pylist(), b.column("toxic")
            for x, y in slices(texts):
                who, place = terms(texts[x:y], column >= 0)
                n = np.bincount(who, minlength=y - x)
                lists = pa.ListArray.from_arrays(pa.array(starts_of(n), pa.int32()), pa.array(column[place], pa.int32()))
                yield pa.RecordBatch.from_arrays([toxic.slice(x, y - x), lists], ["toxic", "f"])

    return run


class Machine:
    """score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>) over the features present."""

    def __init__(self, column: np.ndarray, n: int):
        self.column, self.bias = column, 0.0
        self.w, self.v = np.zeros(n), np.random.default_rng(11).normal(0, 0.05, (n, RANK))

    def raw(self, rows: np.ndarray, feats: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the vector sums, of n rows."""
        v = self.v[feats]
        sums = np.stack([np.bincount(rows, v[:, k], n) for k in range(RANK)], 1)
        squares = np.bincount(rows, (v * v).sum(1), n)
        return self.bias + np.bincount(rows, self.w[feats], n) + 0.5 * ((sums * sums).sum(1) - squares), sums

    def fit(self, rows: np.ndarray, feats: np.ndarray, y: np.ndarray) -> None:
        """Adam on the mean log loss with a ridge, over all rows at once."""
        n, m = len(y), len(self.w)
        share = y.mean()
        self.bias = float(np.log(share / (1 - share)))
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (np.zeros(1), self.w, self.v)]
        for t in range(1, EPOCHS + 1):
            raw, sums = self.raw(rows, feats, n)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / n
            gr = g[rows]
            gw = np.bincount(feats, gr, m) + RIDGE * self.w
            inner = gr[:, None] * (sums[rows] - self.v[feats])
            gv = np.stack([np.bincount(feats, inner[:, k], m) for k in range(RANK)], 1) + RIDGE * self.v
            step = []
            for (a, b), d in zip(state, (np.array([g.sum()]), gw, gv)):
                a *= 0.9
                a += 0.1 * d
                b *= 0.999
                b += 0.001 * d * d
                step.append(RATE * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8))
            self.bias -= float(step[0][0])
            self.w -= step[1]
            self.v -= step[2]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows, place = terms(texts, self.column >= 0)
        raw, _ = self.raw(rows, self.column[place], len(texts))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _counts(known: DataFrame, found) -> DataFrame:
    rows = known.mapInArrow(_by_label(found), "place long, pos long, neg long").groupBy("place")
    return rows.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _most_different(counts: DataFrame, pos: int, neg: int, least: float, n: int) -> list[int]:
    """The ``n`` places whose shares by label differ most, by ``least`` standard errors or more."""
    share = (F.col("pos") + F.col("neg")) / F.lit(pos + neg)
    z = (F.col("pos") / F.lit(pos) - F.col("neg") / F.lit(neg)) / F.sqrt(share * (1 - share) * F.lit(1 / pos + 1 / neg) + 1e-12)
    top = counts.select("place", F.abs(z).alias("z")).where(F.col("z") >= least).orderBy(F.desc("z"), "place").limit(n)
    return [r.place for r in top.collect()]


def fit_machine(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """From up to ``LABELLED`` doc_ids of ``labels`` (doc_id, toxic)."""
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(LABELLED)
    )
    known = documents(docs).where("text is not null").join(F.broadcast(sample), "doc_id").groupBy("doc_id")
    known = stored(known.agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).drop("doc_id"), "labelled")
    total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    pos, neg = total.get(1, 0), total.get(0, 0)
    if not pos or not neg:
        return None
    sc = known.sparkSession.sparkContext
    counts = stored(_counts(known, terms), "term_counts")
    best = _most_different(counts, pos, neg, LEAST_Z, FEATURES)
    often = np.zeros(BUCKETS, bool)
    often[[r.place for r in counts.where(F.col("pos") + F.col("neg") >= PAIR_DOCS).select("place").collect()]] = True
    near = _counts(known, _pairs_of(sc.broadcast(often))).where(F.col("pos") + F.col("neg") >= PAIR_DOCS)
    for pair in _most_different(near, pos, neg, PAIR_Z, PAIRS):
        best += [x for x in divmod(pair, BUCKETS) if x not in best]
    column = np.full(BUCKETS, -1, np.int32)
    column[best] = np.arange(len(best))
    got = known.mapInArrow(_feature_rows(sc.broadcast(column)), "toxic int, f array<int>").collect()
    got.sort(key=lambda r: (r.toxic, r.f))
    n = np.array([len(r.f) for r in got])
    machine = Machine(column, len(best))
    machine.fit(np.repeat(np.arange(len(got)), n), np.array([i for r in got for i in r.f], np.int64), np.array([float(r.toxic) for r in got]))
    return machine


def _score(ref):
    def run(batches):
        machine = ref.value
        for b in batches:
            texts = b.column("text").to_pylist()
            for x, y in slices(texts):
                s = machine.scores(texts[x:y]) if machine else np.zeros(y - x)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(x, y - x), pa.array(s)], ["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) for every row of ``docs``, learnt from ``labels``."""
    ref = docs.sparkSession.sparkContext.broadcast(fit_machine(docs, labels))
    return documents(docs).mapInArrow(_score(ref), "doc_id long, score double")
