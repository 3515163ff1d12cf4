"""Substring dedup by recompression.

Words are symbols. Each round names runs of equal symbols, then splits the
symbols into left and right ones by a hash of their name and names every
adjacent (left, right) pair. A name is a hash of what it stands for, so all
tasks give equal word sequences equal names without exchanging a dictionary.
With every symbol goes its *context*: the word range that decided its extent
and name. A symbol is interior to a ``window``-word window when its context
lies inside the window, so both occurrences of a repeated window have the same
interior symbols. Each window is posted under one of them (the one with the
smallest name; the words of its context are the key), or under the whole window
where it has none.

1. One row per key and document goes through one shuffle; keys of one document
   only can't be part of a repeat and end here.
2. Windows posted under a shared key are verified: their 96-bit fingerprints
   are grouped, and a window is removable in every document but the smallest.
3. Each document drops the words its removable windows cover.

Hot passages are pre-aggregated: a task resolves documents of the same text
slice among themselves and sends one row per key and slice; resolved rows are
dealt out by document. Groups are then read in sorted order with constant
memory. No step holds a group, a document list or a table in one task.

Defined results: null and empty texts have no words; documents shorter than a
window lose nothing; rows that repeat a doc_id never remove words from each
other; rows with a null doc_id take no part and lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import (
    POWERS,
    POWERS2,
    Prefix,
    Words,
    documents,
    mix,
    slices,
    starts_of,
    stored,
    text_bytes,
)

ROUNDS = 3
MULT = np.uint64(0x9E3779B97F4A7C15)
MULT2 = np.uint64(0xD1342543DE82EF95)
ONE = np.uint64(1)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _keep(parts: list[np.ndarray], keep: np.ndarray) -> list[np.ndarray]:
    return [p[keep] for p in parts]


def recompress(h: np.ndarray, sep: np.ndarray, rounds: int = ROUNDS):
    """Symbols after ``rounds`` rounds over the word hashes ``h``; ``sep`` marks
    the places between documents, which never merge. Returns (name, start,
    context start, context end); ends are exclusive."""
    n = len(h)
    name, is_sep = h.copy(), sep.copy()
    start = np.arange(n, dtype=np.int32)
    lo, hi = start.copy(), start + np.int32(1)
    for r in range(rounds):
        salt = np.uint64((0xA0761D6478BD642F * (r + 1)) & 0xFFFFFFFFFFFFFFFF)
        if r == 0:  # runs of one token; later rounds leave equal neighbours apart
            same = (name[1:] == name[:-1]) & ~is_sep[1:]
            if same.any():
                first = np.concatenate(([True], ~same))
                at = np.flatnonzero(first)
                length = np.diff(np.append(at, len(name)))
                run = length > 1
                # where a run ends shows in its neighbours; elsewhere the pair step looks at them
                a, b = at[run], at[run] + length[run] - 1
                new_name = name[at]
                new_name[run] = mix(name[a] * MULT + length[run].astype(np.uint64) + salt)
                new_lo, new_hi = lo[at], hi[at]
                new_hi[run] = hi[np.minimum(b + 1, len(name) - 1)]
                new_lo[run] = lo[np.maximum(a - 1, 0)]
                name, start, lo, hi, is_sep = new_name, start[at], new_lo, new_hi, is_sep[at]
            # a single word is known to be no run from both neighbours
            lo, hi = np.minimum(lo, np.concatenate((lo[:1], start[1:] - 1))), np.maximum(hi, np.minimum(hi + 1, n))
        m = len(name)
        if m < 2:
            break
        right = (mix(name ^ salt) & ONE).astype(bool)
        pair = np.zeros(m, bool)
        pair[:-1] = ~right[:-1] & right[1:] & ~is_sep[:-1] & ~is_sep[1:]
        second = np.zeros(m, bool)
        second[1:] = pair[:-1]
        nxt, prv = np.minimum(np.arange(m) + 1, m - 1), np.maximum(np.arange(m) - 1, 0)
        new_name = np.where(pair, mix(name * MULT2 + name[nxt] * MULT + salt), name)
        # a pair shows by itself; a left symbol alone shows in its successor, a right one in its predecessor
        look_next = pair | (~right & ~second)
        look_prev = right & ~second
        new_hi = np.where(look_next, np.maximum(hi, hi[nxt]), hi)
        new_lo = np.where(look_prev, np.minimum(lo, lo[prv]), np.where(pair, np.minimum(lo, lo[nxt]), lo))
        new_hi = np.where(look_prev, np.maximum(new_hi, hi[prv]), new_hi)
        new_lo = np.where(look_next, np.minimum(new_lo, lo[nxt]), new_lo)
        name, start, lo, hi, is_sep = _keep([new_name, start, new_lo, new_hi, is_sep], ~second)
    return name[~is_sep], start[~is_sep], lo[~is_sep], hi[~is_sep]


class Slice:
    """Words of some documents, laid end to end with one separator between."""

    def __init__(self, texts: list[bytes | None]):
        w = Words(texts)
        self.counts = w.counts
        # word i of document d stands at place i + d + 1; place 0 and each place after a document is a separator
        n = len(w.hashes) + len(texts) + 1
        self.sep = np.zeros(n, bool)
        ends = np.concatenate(([0], np.cumsum(self.counts + 1)))
        self.sep[ends] = True
        self.begin = ends[:-1] + 1
        self.h = np.zeros(n, np.uint64)
        self.h[~self.sep] = w.hashes

    def windows(self, k: int):
        """(place, document) of each k-word window."""
        per = np.maximum(self.counts - k + 1, 0)
        doc = np.repeat(np.arange(len(per)), per)
        at = np.arange(per.sum()) - np.repeat(starts_of(per)[:-1], per) + self.begin[doc]
        return at, doc

    def keys(self, at: np.ndarray, k: int) -> np.ndarray:
        """The key each window is posted under."""
        name, start, lo, hi = recompress(self.h, self.sep)
        n = len(self.h)
        rank = np.full(n + k, TOP)
        rank[start] = mix(name) >> ONE
        c_lo, c_hi = np.zeros(n + k, np.int32), np.full(n + k, n + 2 * k, np.int32)
        c_lo[start], c_hi[start] = lo, hi
        best = np.full(len(at), TOP)
        where = np.zeros(len(at), np.int64)
        for j in range(k):
            p = at + j
            r = rank[p]
            ok = (r < best) & (c_lo[p] >= at) & (c_hi[p] <= at + k)
            best = np.where(ok, r, best)
            where = np.where(ok, p, where)
        found = best != TOP
        pre = Prefix(self.h, POWERS)
        a = np.where(found, c_lo[where], at)
        b = np.where(found, c_hi[where], at + k)
        return pre.of(a, b)

    def prints(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """64 + 32 bits of each window's word sequence."""
        one, two = Prefix(self.h, POWERS), Prefix(self.h, POWERS2)
        return one.of(at, at + k).view(np.int64), (two.of(at, at + k) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _batch_slices(b: pa.RecordBatch):
    """(rows, doc ids, texts) of a batch by slice, in doc_id order."""
    ids, texts = b.column("doc_id").to_numpy(), text_bytes(b)
    for x, y in slices(texts):
        rows = x + np.argsort(ids[x:y], kind="stable")
        yield rows, ids[rows], [texts[i] for i in rows]


def _post(k: int):
    """(k, doc_id, flag) rows; flag 0: to be grouped, 1: the same, shared inside
    the slice already, 2: shared for sure, not to be grouped."""

    def run(batches):
        for b in batches:
            for _rows, ids, texts in _batch_slices(b):
                s = Slice(texts)
                at, doc = s.windows(k)
                if not len(at):
                    continue
                key = s.keys(at, k)
                step = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
                key, d = key[step], ids[doc[step]]
                u, first, inv = np.unique(key, return_index=True, return_inverse=True)
                owner = d[first]
                other = d > owner[inv]
                flag = np.zeros(len(u), np.int8)
                flag[inv[other]] = 1
                out_k = np.concatenate((u, key[other])).view(np.int64)
                out_d = np.concatenate((owner, d[other]))
                out_f = np.concatenate((flag, np.full(int(other.sum()), 2, np.int8)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_k), pa.array(out_d), pa.array(out_f)], ["k", "doc_id", "flag"]
                )

    return run


def _shared(batches):
    """Rows sorted by (k, doc_id): (doc_id, k) of the keys of two rows or more."""
    held = None  # (k, doc) of a group's first row, not yet known to be shared
    last = None
    for b in batches:
        k, d, f = (b.column(i).to_numpy() for i in range(3))
        done = f == 2
        out_d, out_k = [d[done]], [k[done]]
        k, d, f = k[~done], d[~done], f[~done]
        if len(k):
            new = np.concatenate(([last is None or k[0] != last], k[1:] != k[:-1]))
            followed = np.concatenate((~new[1:], [False]))
            emit = ~new | followed | (f == 1)
            if held is not None and not new[0]:
                out_d.append(np.array([held[1]]))
                out_k.append(np.array([held[0]]))
            held = (k[-1], d[-1]) if not emit[-1] else None
            last = k[-1]
            out_d.append(d[emit])
            out_k.append(k[emit])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out_d), pa.int64()), pa.array(np.concatenate(out_k), pa.int64())], ["doc_id", "k"]
        )


def _list_values(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat long values of a list column and their number by row (null: none)."""
    n = col.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    return col.flatten().to_numpy(zero_copy_only=False), n


def _candidates(k: int):
    """Fingerprints of the windows under shared keys: (p, q, doc_id, done);
    done: a smaller document of the slice has the window."""

    def run(batches):
        for b in batches:
            vals, n = _list_values(b.column("ks"))
            v0 = starts_of(n)
            for rows, ids, texts in _batch_slices(b):
                s = Slice(texts)
                at, doc = s.windows(k)
                if not len(at):
                    continue
                key = s.keys(at, k)
                mine = np.concatenate([vals[v0[r] : v0[r + 1]] for r in rows]).view(np.uint64)
                who = np.repeat(mix(np.arange(len(rows), dtype=np.uint64) + ONE), n[rows])
                hit = np.isin(key ^ mix(doc.astype(np.uint64) + ONE), mine ^ who)
                at, d = at[hit], ids[doc[hit]]
                p, q = s.prints(at, k)
                both = p.view(np.uint64) ^ mix(q.view(np.uint32).astype(np.uint64) + ONE)
                u, first, inv = np.unique(both, return_index=True, return_inverse=True)
                done = d > d[first][inv]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.array(q), pa.array(d), pa.array(done.astype(np.int8))], ["p", "q", "doc_id", "done"]
                )

    return run


def _later(batches):
    """Rows sorted by (p, q, doc_id): (doc_id, p) where a smaller document has the window."""
    last = None  # (p, q, smallest doc)
    for b in batches:
        p, q, d, f = (b.column(i).to_numpy() for i in range(4))
        done = f == 1
        out_d, out_p = d[done], p[done]
        p, q, d = p[~done], q[~done], d[~done]
        if len(p):
            new = np.concatenate(
                ([last is None or p[0] != last[0] or q[0] != last[1]], (p[1:] != p[:-1]) | (q[1:] != q[:-1]))
            )
            head = np.maximum.accumulate(np.where(new, np.arange(len(p)), -1))
            least = np.where(head >= 0, d[head], last[2] if last else 0)
            later = d > least
            last = (p[-1], q[-1], least[-1])
            out_d, out_p = np.concatenate((out_d, d[later])), np.concatenate((out_p, p[later]))
        yield pa.RecordBatch.from_arrays([pa.array(out_d, pa.int64()), pa.array(out_p, pa.int64())], ["doc_id", "p"])


def _staying(texts: list[bytes], gone: list[np.ndarray], k: int) -> list[np.ndarray]:
    """By document, which words no window of ``gone`` covers."""
    s = Slice(texts)
    at, doc = s.windows(k)
    p, _ = s.prints(at, k)
    who = np.repeat(mix(np.arange(len(texts), dtype=np.uint64) + ONE), [len(g) for g in gone])
    hit = at[np.isin(p.view(np.uint64) ^ mix(doc.astype(np.uint64) + ONE), np.concatenate(gone).view(np.uint64) ^ who)]
    edge = np.bincount(hit, minlength=len(s.h) + 1) - np.bincount(hit + k, minlength=len(s.h) + 1)
    stay = np.cumsum(edge) == 0
    return [stay[b : b + c] for b, c in zip(s.begin, s.counts)]


def _cut(k: int):
    def run(batches):
        for b in batches:
            doc_ids = b.column("doc_id")
            texts = text_bytes(b)
            vals, n = _list_values(b.column("ps"))
            v0 = starts_of(n)
            for x, y in slices(texts):
                kept, n_removed, n_words = [], np.zeros(y - x, np.int64), np.zeros(y - x, np.int64)
                some = [i for i in range(x, y) if n[i] and texts[i]]
                stay = _staying([texts[i] for i in some], [vals[v0[i] : v0[i + 1]] for i in some], k) if some else []
                stay = dict(zip(some, stay))
                for i in range(x, y):
                    own = (texts[i] or b"").split()
                    n_words[i - x] = len(own)
                    if i in stay:
                        own = [own[j] for j in np.flatnonzero(stay[i])]
                        n_removed[i - x] = n_words[i - x] - len(own)
                    kept.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(x, y - x),
                        pa.array(n_words),
                        pa.array(n_removed),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return run


def repeated_windows(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, p): fingerprints of the windows each document shares with a smaller one."""
    d = documents(docs).where("doc_id is not null and text is not null")
    posts = d.mapInArrow(_post(window), "k long, doc_id long, flag byte")
    shared = stored(
        posts.repartition(F.expr("if(flag = 2, xxhash64(doc_id, k), k)"))
        .sortWithinPartitions("k", "doc_id")
        .mapInArrow(_shared, "doc_id long, k long"),
        "shared_symbols",
    )
    lists = shared.groupBy("doc_id").agg(F.collect_list("k").alias("ks"))
    prints = d.join(lists, "doc_id").mapInArrow(_candidates(window), "p long, q int, doc_id long, done byte")
    return stored(
        prints.repartition(F.expr("if(done = 1, xxhash64(doc_id, p), p)"))
        .sortWithinPartitions("p", "q", "doc_id")
        .mapInArrow(_later, "doc_id long, p long"),
        "repeated_windows",
    )


def dedup_substrings(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): every row of ``docs`` without the
    words of windows that also start in a document with a smaller doc_id."""
    lists = repeated_windows(docs, window).groupBy("doc_id").agg(F.collect_set("p").alias("ps"))
    return (
        documents(docs)
        .join(lists, "doc_id", "left")
        .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_text string")
    )
