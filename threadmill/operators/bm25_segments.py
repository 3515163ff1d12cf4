"""What the tasks of ``bm25_index`` do with whole segments, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .topk import bounded_topk

#: Tokens counted at once (one document at least), and rows given back at once.
TOKENS, ROWS = 1 << 20, 1 << 15


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int32())


def _list_of(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(_ints(starts), values)


def _peaks(code: np.ndarray, tf: np.ndarray, dl: np.ndarray) -> np.ndarray:
    """Places of the hits, by term, that no hit of the same term beats in both count and length."""
    order = np.lexsort((dl, -tf, code))
    # falls at every change of the term, and within one at every shorter document
    low = np.minimum.accumulate(dl[order] - code[order] * (int(dl.max()) + 1))
    return order[np.concatenate(([True], low[1:] < low[:-1]))]


class _Segment:
    """Documents of a task that are not given back yet."""

    def __init__(self):
        self.ids, self.dl, self.terms, self.hits = [], [], [], []
        self.docs = self.known = self.n = 0

    def add(self, ids: pa.Array, dl: np.ndarray, tokens: pa.Array) -> None:
        """``dl`` tokens of each document, in order."""
        found = tokens.dictionary_encode()
        known = max(len(found.dictionary), 1)
        key = np.repeat(np.arange(len(dl)), dl) * known + found.indices.to_numpy()
        key, tf = np.unique(key, return_counts=True)
        self.hits.append((self.docs + key // known, self.known + key % known, tf))
        self.ids.append(ids)
        self.dl.append(dl)
        self.terms.append(found.dictionary)
        self.docs, self.known, self.n = self.docs + len(dl), self.known + len(found.dictionary), self.n + len(key)

    def rows(self, segment: int, schema: pa.Schema):
        """Its documents as one row, then a row for each term, in order of terms."""
        ids = pa.concat_arrays(self.ids)
        at = np.arange(len(ids))
        if not pa.types.is_nested(ids.type):  # rows with nested ids come in their order
            order = pc.sort_indices(ids, null_placement="at_start")
            ids, at[order.to_numpy()] = ids.take(order), np.arange(len(ids))
        one = {"segment": pa.array([segment]), "ids": _list_of(ids, np.array([0, len(ids)]))}
        yield pa.RecordBatch.from_arrays([one.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)
        if not self.n:
            return
        terms = pa.concat_arrays(self.terms).dictionary_encode()
        order = pc.sort_indices(terms.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        doc, code, tf = (np.concatenate(x) for x in zip(*self.hits, strict=True))
        code, dl, at = rank[terms.indices.to_numpy()[code]], np.concatenate(self.dl)[doc], at[doc]
        order_of = np.argsort(code * len(ids) + at)
        code, tf, dl, at = code[order_of], tf[order_of], dl[order_of], at[order_of]
        ends = np.arange(len(order) + 1)
        starts, peaks = np.searchsorted(code, ends), _peaks(code, tf, dl)
        found = {
            "term": terms.dictionary.take(order).cast(schema.field("term").type),
            "segment": pa.array(np.full(len(order), segment)),
            "n": pa.array(np.diff(starts)),
            "peaks": _list_of(pa.StructArray.from_arrays([_ints(tf[peaks]), _ints(dl[peaks])], names=["tf", "dl"]),
                              np.searchsorted(code[peaks], ends)),
            "at": _list_of(_ints(at), starts),
            "tf": _list_of(_ints(tf), starts),
            "dl": _list_of(_ints(dl), starts),
        }
        batch = pa.RecordBatch.from_arrays([found.get(f.name, pa.nulls(len(order), f.type)) for f in schema], schema=schema)
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _schema(id_type: pa.DataType) -> pa.Schema:
    ints, peak = pa.list_(pa.int32()), pa.struct([("tf", pa.int32()), ("dl", pa.int32())])
    return pa.schema([("term", pa.string()), ("segment", pa.int64()), ("n", pa.int64()), ("peaks", pa.list_(peak)),
                      ("at", ints), ("tf", ints), ("dl", ints), ("ids", pa.list_(id_type))])


def inverted(docs: int, hits: int):
    """(no, id, tokens) -> (term, segment, n, peaks, at, tf, dl, ids). The segments of a task,
    whose number are the upper bits of ``no``, hold ``docs`` documents, fewer if these
    have ``hits`` different terms or more."""

    def run(batches):
        segment, number, schema = _Segment(), None, None
        for b in batches:
            if not b.num_rows:
                continue
            if number is None:
                number, schema = (b.column("no")[0].as_py() >> 33) << 32, _schema(b.column("id").type)
            dl = pc.fill_null(pc.list_value_length(b.column("tokens")), 0).to_numpy().astype(np.int64)
            ends = np.cumsum(dl)
            tokens, i = b.column("tokens").flatten(), 0
            while i < len(dl):
                begin = int(ends[i] - dl[i])
                j = min(max(int(np.searchsorted(ends, begin + TOKENS, "right")), i + 1), i + docs - segment.docs, len(dl))
                segment.add(b.column("id").slice(i, j - i), dl[i:j], tokens.slice(begin, int(ends[j - 1]) - begin))
                i = j
                if segment.docs >= docs or segment.n >= hits:
                    yield from segment.rows(number, schema)
                    segment, number = _Segment(), number + 1
        if segment.docs:
            yield from segment.rows(number, schema)

    return run


def best_of_segment(k: int, k1: float, b: float, average: float, places: int, slack: float):
    """cogroup of the queries asked of a segment (query_id, floor, tids) with the blocks
    it has of their terms (tid, idf, at, tf, dl): what may be among the ``k`` best of a query
    (query_id, segment, at, score), of ties those with the smallest ids."""

    def run(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        who, ats, scores = [], [], []
        if asked.num_rows and blocks.num_rows:
            lens = pc.list_value_length(blocks.column("at")).to_numpy()
            end = np.cumsum(lens)
            begin = end - lens
            at, tf, dl = (blocks.column(x).combine_chunks().flatten().to_numpy() for x in ("at", "tf", "dl"))
            part = tf * (k1 + 1.0) / (tf + k1 * ((1.0 - b) + b * dl / average))
            part *= np.repeat(blocks.column("idf").to_numpy(), lens)
            tid = blocks.column("tid").to_numpy()
            order = np.argsort(tid)
            tids = asked.column("tids").combine_chunks()
            ends = np.cumsum(pc.list_value_length(tids).to_numpy())
            tids = tids.flatten().to_numpy()
            slot = np.minimum(np.searchsorted(tid[order], tids), len(tid) - 1)
            row = np.where(tid[order][slot] == tids, order[slot], -1)
            floor = np.nan_to_num(asked.column("floor").to_numpy().astype(np.float64), nan=-np.inf)
            size = int(at.max()) + 1
            for q, terms in enumerate(np.split(row, ends[:-1])):
                total = np.zeros(size)
                for r in terms[terms >= 0].tolist():
                    total[at[begin[r] : end[r]]] += part[begin[r] : end[r]]
                held = np.flatnonzero((total > 0) & (total + slack >= floor[q]))
                held = held[bounded_topk(total[held], held, k, places)]
                who.append(np.full(len(held), q))
                ats.append(held)
                scores.append(total[held])
        joined = lambda arrays, kind: np.concatenate([np.empty(0, kind), *arrays])
        who = joined(who, np.int64)
        segment = asked.column("a_segment")[0].as_py() if asked.num_rows else 0
        return pa.table({
            "query_id": asked.column("query_id").take(pa.array(who, pa.int64())),
            "segment": pa.array(np.full(len(who), segment), pa.int64()),
            "at": pa.array(joined(ats, np.int64), pa.int32()),
            "score": pa.array(joined(scores, np.float64)),
        })

    return run
