"""Ranked lexical search with the Best Position Algorithm.

Every term of a query has an impact list: the documents holding it, highest
impact first. Lists are read in parallel; a document met for the first time is
looked up in all other lists (direct access), which gives its whole score and
its *position* in each of them. The best position of a list is the end of its
leading run of positions seen either way; no unseen document can stand before
it, so the impacts that follow the best positions bound every unseen score. This
bound is at most that of the last positions read. A search stops once the bound is
strictly below the k-th score, so ties are never cut.

Documents are scanned once for each block of queries (``BLOCK_TERMS`` distinct
terms or one query): one row a document with its length and the counts of query
terms. Rows are read from storage in shards of about ``SHARD_POSTINGS`` postings,
as they lie, without a shuffle; a shard sorts its own impact lists, so a term
that all documents hold is a short list in every shard. A first pass over the
shards reads ``PILOT`` positions of each list; the k-th of the scores found is a
floor for the second pass, whose shards stop strictly below it and return
little more than the answer.

Weights, lengths and document counts cover all documents. Only the term hashes
and weights of a block and one floor a query of it are broadcast.

Terms are known by 64-bit hashes. Defined results: a null or empty text has no
terms; rows with a null doc_id or item_id take no part; each row of a repeated
doc_id is a document; of rows that repeat an item_id the smallest text counts; a
term that no document or nearly every document holds weighs 0; documents with
score 0 are not returned; with fewer documents all are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import BYTE_LOWER, POWERS3, Prefix, documents, slices, starts_of, stored, text_bytes

#: Distinct terms of a block of queries, about.
BLOCK_TERMS = 1 << 18
#: Postings a shard holds, about (one document at least).
SHARD_POSTINGS = 1 << 20
#: Positions of each list read at once, and in all by the first pass.
STEP, PILOT = 64, 192
#: A term gets direct access by table if one document in DENSE of a shard holds it.
DENSE = 8

#: Bytes of terms: ASCII letters and digits, and all bytes of other characters.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of some texts in order, and where each text's begin."""
    joined = b" ".join(t or b"" for t in texts) + b" "
    buf = np.frombuffer(joined, np.uint8)
    inside = TERM[buf]
    edge = np.empty(len(buf), bool)
    edge[0] = inside[0]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    at = np.flatnonzero(edge)
    begin, end = at[0::2], at[1::2]
    lens = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    first = np.searchsorted(begin, starts_of(lens + 1))
    return Prefix(BYTE_LOWER[buf], POWERS3).of(begin, end), first


def _counted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) of the distinct terms of each text, in order."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return d[at], h[at], np.diff(np.append(at, len(d)))


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    bounds = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _query_terms(batches):
    for b in batches:
        texts = text_bytes(b)
        for i, j in slices(texts):
            d, h, c = _counted(*term_hashes(texts[i:j]))
            if len(d):
                yield pa.RecordBatch.from_arrays(
                    [b.column("item_id").slice(i, j - i).take(pa.array(d)), pa.array(h.view(np.int64)), pa.array(c)],
                    ["item_id", "term", "times"],
                )


def _postings(ref):
    """One row a document: its id, number of terms, and its query terms with counts."""

    def run(batches):
        wanted = ref.value
        for b in batches:
            texts = text_bytes(b)
            for i, j in slices(texts):
                h, first = term_hashes(texts[i:j])
                n = np.diff(first)
                slot = np.minimum(np.searchsorted(wanted, h), max(len(wanted) - 1, 0))
                hit = wanted[slot] == h if len(wanted) else np.zeros(len(h), bool)
                kept = np.concatenate(([0], np.cumsum(hit)))[first]
                d, t, c = _counted(slot[hit].astype(np.uint64), kept)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(i, j - i),
                        pa.array(n, pa.int64()),
                        _lists(t.astype(np.int32), d, j - i, pa.int32()),
                        _lists(c, d, j - i, pa.int64()),
                    ],
                    ["doc_id", "n", "terms", "tf"],
                )

    return run


def _integers(limit: int):
    """The dtype in which integers up to ``limit`` are exact."""
    return np.int64 if limit < 2**62 else object


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """(10**9 tf) div (1000 tf + 8 m) with m = 25 + (75 n docs) div length."""
    kind = _integers(75 * docs * int(n.max(initial=0)))
    m = 25 + (75 * n.astype(kind) * docs) // length
    kind = _integers(10**9 * int(tf.max(initial=0)))
    return ((10**9 * tf.astype(kind)) // (1000 * tf.astype(kind) + 8 * m)).astype(np.int64)


class Shard:
    """The impact lists of some documents, with direct access by document."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        cut = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        ends = np.append(cut[1:], len(term))
        self.ranges = {int(term[a]): (int(a), int(b)) for a, b in zip(cut, ends)}
        self.docs = docs
        self._access: dict[int, tuple] = {}

    def access(self, term: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, impact) of ``docs`` in the list of ``term``; position -1 where absent."""
        a, b = self.ranges[term]
        if term not in self._access:
            if (b - a) * DENSE > self.docs:
                where = np.full(self.docs, -1, np.int32)
                where[self.doc[a:b]] = np.arange(b - a)
                self._access[term] = (None, where)
            else:
                where = np.argsort(self.doc[a:b], kind="stable")
                self._access[term] = (self.doc[a:b][where], where)
        ids, where = self._access[term]
        if ids is None:
            pos = where[docs]
        else:
            i = np.minimum(np.searchsorted(ids, docs), len(ids) - 1)
            pos = np.where(ids[i] == docs, where[i], -1)
        return pos, np.where(pos >= 0, self.impact[a + np.maximum(pos, 0)], 0)

    def search(self, query: list[tuple[int, int]], k: int, floor: int, depth: int | None = None):
        """(documents, scores, positions read) of the k best documents and their
        ties, by lists of (term, weight); nothing below ``floor`` is sought."""
        lists = [(t, w, *self.ranges[t]) for t, w in query if w > 0 and t in self.ranges]
        seen = np.zeros(self.docs, bool)
        passed = [np.zeros(b - a + 1, bool) for _, _, a, b in lists]  # positions seen; the end never is
        best = [0] * len(lists)
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, STEP
        while lists and (depth is None or at < depth):
            new = np.concatenate([self.doc[a + at : min(a + at + step, b)] for _, _, a, b in lists])
            new = np.unique(new)
            new = new[~seen[new]]
            seen[new] = True
            got = np.zeros(len(new), np.int64)
            for i, (t, w, a, b) in enumerate(lists):
                pos, impact = self.access(t, new)
                got += w * impact
                passed[i][pos[pos >= 0]] = True
            at += step
            found, scores = np.concatenate((found, new)), np.concatenate((scores, got))
            bound = 0
            for i, (t, w, a, b) in enumerate(lists):
                best[i] += int(np.argmin(passed[i][best[i] :]))
                if a + best[i] < b:
                    bound += w * int(self.impact[a + best[i]])
            least = max(floor, int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0)
            keep = scores >= max(least, 1)
            found, scores = found[keep], scores[keep]
            if bound < least or bound == 0:
                break
            step *= 2
        return found, scores, at


def _shards(batches):
    """Tables of consecutive rows with about SHARD_POSTINGS postings each."""
    held, size = [], 0
    for b in batches:
        ends = b.column("terms").offsets.to_numpy()
        i = 0
        while i < b.num_rows:
            room = int(ends[i]) + max(SHARD_POSTINGS - size, 1)
            j = max(int(np.searchsorted(ends, room, "right")) - 1, i + 1)
            held.append(b.slice(i, j - i))
            size += int(ends[j] - ends[i])
            i = j
            if size >= SHARD_POSTINGS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched(ref, k: int, depth: int | None):
    def run(batches):
        queries, floors, docs, length = ref.value
        for t in _shards(batches):
            ids, n = t["doc_id"].to_numpy(), t["n"].to_numpy()
            lists = t["terms"].combine_chunks()
            doc = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            tf = t["tf"].combine_chunks().flatten().to_numpy()
            shard = Shard(doc, lists.flatten().to_numpy(), impacts(tf, n[doc], docs, length), len(ids))
            out = [[], [], []]
            for item, query in queries.items():
                d, s, _ = shard.search(query, k, floors.get(item, 0), depth)
                first = np.lexsort((ids[d], -s))[:k]
                out[0].append(np.full(len(first), item))
                out[1].append(ids[d[first]])
                out[2].append(s[first])
            cols = [pa.array(np.concatenate(c or [np.zeros(0)]).astype(np.int64)) for c in out]
            yield pa.RecordBatch.from_arrays(cols, ["item_id", "doc_id", "score"])

    return run


def _weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _search_block(corpus: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    spark = corpus.sparkSession
    sc = spark.sparkContext
    rows = terms.collect()  # one block of queries
    wanted = np.unique(np.array([r.term for r in rows], np.int64).view(np.uint64))
    hashes = sc.broadcast(wanted)
    postings = corpus.mapInArrow(_postings(hashes), "doc_id long, n long, terms array<int>, tf array<long>")
    postings = stored(postings, "postings")
    docs, length = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    held = postings.select(F.explode("terms").alias("slot")).groupBy("slot").count().collect()
    df = {r.slot: r["count"] for r in held}
    queries: dict[int, list[tuple[int, int]]] = {}
    for r in rows:
        slot = int(np.searchsorted(wanted, np.uint64(r.term % 2**64)))
        if slot in df:
            queries.setdefault(r.item_id, []).append((slot, r.times * _weight(docs, df[slot])))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    floors: dict[int, int] = {}
    out = None
    for depth in (PILOT, None):
        ref = sc.broadcast((queries, floors, docs, length))
        hits = postings.where("size(terms) > 0").mapInArrow(_searched(ref, k, depth), "item_id long, doc_id long, score long")
        out = stored(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "hits")
        ref.destroy()
        if depth:
            floors = {r.item_id: r.score for r in out.where(F.col("rank") == k).select("item_id", "score").collect()}
    hashes.destroy()
    return out.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of ``docs`` (doc_id, text) for
    each of ``items`` (item_id, text)."""
    corpus = documents(docs).where("doc_id is not null")
    one = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    one = one.where("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    terms = stored(one.mapInArrow(_query_terms, "item_id long, term long, times long"), "query_terms")
    blocks = max(1, -(-2 * terms.select("term").distinct().count() // BLOCK_TERMS))
    out = None
    for block in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found = _search_block(corpus, part, k)
        out = found if out is None else out.union(found)
    return out
