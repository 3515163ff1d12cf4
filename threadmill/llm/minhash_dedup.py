"""MinHash near-dedup through a signature-coordinate inverted join.

A document's set is its distinct shingles of ``words`` lower-cased words. Sets
that are equal collapse into one class first. Each class is posted under its
``COORDS`` (coordinate, value) pairs. Two classes of similarity ``percent`` or
more agree in at least ``matches`` coordinates (the chance that a link does not
is below ``MISS``; 34 of 64 at 0.80), so

* lists of one class are skipped, and classes left with fewer than ``matches``
  coordinates have no partner;
* of its m coordinates left a class needs only the m - matches + 1 in the
  shortest lists (prefix): two classes with ``matches`` in common meet in one.

A list is never expanded into its pairs. Its smallest member is its pivot, and
classes that meet in a list meet in the group of its pivot. First each member
is compared with the pivot: collisions are counted on the signatures, pairs
above the match threshold confirmed on full sets, links contracted into
components. Then, within a group, only members outside the pivot's component
are compared with the members of other components, block against block, on
full sets; a block returns no more links than it joins components. No link
between different texts is lost, and no group is held by one task.

Defined results: no words or a null text: an empty set, linked with nothing;
fewer words than a shingle: the whole sequence is the one shingle; repeated
rows count as copies; of different texts under one doc_id the one of the
smallest digest is compared with other texts; rows with a null doc_id are linked with
nothing and kept (their component_id is null); other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import (
    POWERS,
    Prefix,
    Words,
    documents,
    mix,
    slices,
    starts_of,
    stored,
    text_bytes,
)
from threadmill.llm.components import components

COORDS = 64
MISS = 1e-6
#: Shingles on each side of a block comparison, and columns multiplied at once.
BLOCK = 60_000
WIDE = 4096



def matches(percent: int) -> int:
    """Coordinates in which two sets of ``percent`` similarity agree, but for a
    chance below ``MISS``."""
    p, below = percent / 100, 0.0
    for m in range(COORDS + 1):
        below += math.comb(COORDS, m) * p**m * (1 - p) ** (COORDS - m)
        if below >= MISS:
            break
    if m < 2:
        raise ValueError(f"{COORDS} coordinates cannot tell sets of {percent} % similarity")
    return m


A = mix(np.arange(1, COORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _shingles(texts: list[bytes | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the texts in order (repeats included) and their number by text."""
    w = Words(texts, lower=True)
    per = np.where(w.counts >= k, w.counts - k + 1, np.minimum(w.counts, 1))
    doc = np.repeat(np.arange(len(per)), per)
    a = np.arange(per.sum()) - np.repeat(starts_of(per)[:-1], per) + w.first[:-1][doc]
    return Prefix(w.hashes, POWERS).of(a, a + np.minimum(w.counts, k)[doc]), per


def _sign(k: int):
    def run(batches):
        for b in batches:
            texts, ids = text_bytes(b), b.column("doc_id")
            for x, y in slices(texts):
                h, per = _shingles(texts[x:y], k)
                first = starts_of(per)
                n, digest = np.zeros(y - x, np.int64), []
                for i in range(y - x):
                    own = np.unique(h[first[i] : first[i + 1]])
                    n[i] = len(own)
                    digest.append(xxhash.xxh3_128_digest(own.tobytes()))
                sig = np.zeros((y - x, COORDS), np.uint32)
                some = np.flatnonzero(per)
                if len(some):
                    at = first[some]
                    for c in range(COORDS):
                        sig[some, c] = np.minimum.reduceat(h * A[c], at) >> np.uint64(32)
                d = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(x, y - x),
                        pa.array(n),
                        pa.array(d[:, 0]),
                        pa.array(d[:, 1]),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                    ],
                    ["doc_id", "n", "hi", "lo", "sig"],
                )

    return run


def _postings(batches):
    """(key, doc_id) for each coordinate of each signature."""
    for b in batches:
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, COORDS)
        key = sig.astype(np.uint64) | (np.arange(COORDS, dtype=np.uint64) << np.uint64(32))[None, :]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(b.column("doc_id").to_numpy(), COORDS))],
            ["key", "doc_id"],
        )


def _collide(least: int):
    """Pairs whose signatures agree in ``least`` coordinates or more."""

    def run(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, COORDS) for c in ("sa", "sb"))
            yield b.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= least))

    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            texts, ids = text_bytes(b), b.column("doc_id")
            for x, y in slices(texts):
                h, per = _shingles(texts[x:y], k)
                first = starts_of(per)
                own = [np.unique(h[first[i] : first[i + 1]]) for i in range(y - x)]
                off = starts_of(np.array([len(o) for o in own]))
                flat = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
                d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(o.tobytes()) for o in own), "<i8").reshape(-1, 2)
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(x, y - x), pa.array(d[:, 0]), pa.array(d[:, 1]), lists], ["doc_id", "hi", "lo", "s"]
                )

    return run


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Intersection size of each set of ``x`` with each set of ``y``."""
    out = np.zeros((len(x), len(y)), np.float32)
    fx, fy = np.concatenate(x), np.concatenate(y)
    rx, ry = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    both = np.intersect1d(fx, fy)
    for c in range(0, len(both), WIDE):
        cols = both[c : c + WIDE]
        m = []
        for f, r, n in ((fx, rx, len(x)), (fy, ry, len(y))):
            p = np.searchsorted(cols, f)
            hit = (p < len(cols)) & (cols[np.minimum(p, len(cols) - 1)] == f)
            z = np.zeros((n, len(cols)), np.float32)
            z[r[hit], p[hit]] = 1
            m.append(z)
        out += m[0] @ m[1].T
    return out


def _cross_links(percent: int):
    """cogroup of one block of outsiders with one block of members: links that
    join different components, a spanning forest of them."""

    def run(key, left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64")})
        x, y = [np.asarray(s) for s in left["l_s"]], [np.asarray(s) for s in right["r_s"]]
        nx, ny = np.array([len(s) for s in x]), np.array([len(s) for s in y])
        inter = _overlaps(x, y)
        union = nx[:, None] + ny[None, :] - inter
        cx, cy = left["l_component"].to_numpy(), right["r_component"].to_numpy()
        i, j = np.nonzero((100 * inter >= percent * union) & (cx[:, None] != cy[None, :]))
        a, b = left["l_doc_id"].to_numpy(), right["r_doc_id"].to_numpy()
        root: dict = {}

        def find(c):
            while root.get(c, c) != c:
                c = root[c]
            return c

        out = []
        for u, v in zip(i, j):
            p, q = find(cx[u]), find(cy[v])
            if p != q:
                root[p] = q
                out.append((a[u], b[v]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    d, least = documents(docs), matches(percent)
    signed = stored(d.mapInArrow(_sign(words), "doc_id long, n long, hi long, lo long, sig binary"), "signatures")
    known = signed.where("doc_id is not null and n > 0")
    copies = stored(
        known.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"),
        "copies",
    )
    classes = known.select("doc_id", "n", "hi", "lo", "sig").join(copies, ["hi", "lo"], "left")
    classes = classes.where("rep is null or rep = doc_id").select("doc_id", "hi", "lo", "n", "sig")
    # one text a doc_id: rows equal in digest are equal in all else
    first = classes.groupBy("doc_id").agg(F.min(F.struct("hi", "lo")).alias("d")).select("doc_id", "d.hi", "d.lo")
    classes = stored(classes.join(first, ["doc_id", "hi", "lo"]).dropDuplicates(["doc_id"]), "classes")

    postings = classes.select("doc_id", "sig").mapInArrow(_postings, "key long, doc_id long")
    lists = stored(postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "lists")
    prefix = stored(
        postings.join(lists, "key")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("l"))
        .where(F.size("l") >= least)
        .select("doc_id", F.explode(F.slice("l", F.lit(1), F.size("l") - (least - 1))).alias("e"))
        .select(F.col("e.key").alias("key"), "doc_id"),
        "prefixes",
    )
    pivots = stored(prefix.groupBy("key").agg(F.min("doc_id").alias("pivot")), "pivots")
    groups = stored(
        prefix.join(pivots, "key").where("doc_id <> pivot").select("pivot", "doc_id").distinct(), "groups"
    )
    if groups.isEmpty():
        found = None
    else:
        found = _confirmed(d, classes, groups, words, percent)

    out = signed.select("doc_id", "n", "hi", "lo").join(copies, ["hi", "lo"], "left")
    out = out.withColumn("rep", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")))
    if found is not None:
        out = out.join(found.withColumnRenamed("id", "rep"), "rep", "left")
        out = out.withColumn("rep", F.coalesce("component", "rep"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("rep"), F.lit(True)).alias("kept"),
    )


def _confirmed(d: DataFrame, classes: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """Components (id, component) of the links inside the pivot groups."""
    members = stored(groups.select("doc_id").union(groups.select(F.col("pivot"))).distinct(), "members")
    sets = d.join(members, "doc_id", "left_semi").mapInArrow(_sets(words), "doc_id long, hi long, lo long, s array<long>")
    sets = sets.join(classes.select("doc_id", "hi", "lo"), ["doc_id", "hi", "lo"], "left_semi")
    sets = stored(sets.select("doc_id", "s").dropDuplicates(["doc_id"]), "sets")
    sig = classes.select("doc_id", "n", "sig")
    pairs = (
        groups.join(sig, "doc_id")
        .select("pivot", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
        .join(sig.withColumnRenamed("doc_id", "pivot"), "pivot")
        .where((100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")))
        .select(F.col("pivot").alias("a"), "b", F.col("sig").alias("sa"), "sb")
        .mapInArrow(_collide(matches(percent)), "a long, b long")
    )
    links = stored(
        stored(pairs, "pairs")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
        .join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a")
        .withColumn("i", F.size(F.array_intersect("sa", "sb")))
        .where(100 * F.col("i") >= percent * (F.size("sa") + F.size("sb") - F.col("i")))
        .select("a", "b"),
        "links",
    )
    first = stored(components(links), "components")

    # members of each pivot's group (the pivot included) with component and set size
    named = groups.union(groups.select("pivot", F.col("pivot").alias("doc_id")).distinct())
    named = (
        named.join(first.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
        .join(first.select(F.col("id").alias("pivot"), F.col("component").alias("home")), "pivot", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .withColumn("home", F.coalesce("home", "pivot"))
        .join(sig.select("doc_id", "n"), "doc_id")
    )
    named = stored(named, "named")
    sizes = stored(
        named.groupBy("pivot")
        .agg(
            F.sum("n").alias("total"),
            F.sum(F.when(F.col("component") != F.col("home"), F.col("n"))).alias("outside"),
            F.sum(F.when(F.col("component") != F.col("home"), 1)).alias("outsiders"),
            F.count(F.lit(1)).alias("all"),
        )
        # one outsider beside the pivot alone has been compared already
        .where("outsiders > 0 and all > 2")
        .select(
            "pivot",
            F.ceil(F.col("outside") / BLOCK).alias("gx"),
            F.ceil(F.col("total") / BLOCK).alias("gy"),
        ),
        "group_sizes",
    )
    if sizes.isEmpty():
        return first
    within = named.join(sizes, "pivot").join(sets, "doc_id")
    place = F.pmod(F.xxhash64("doc_id", "pivot"), F.lit(1 << 30))
    left = (
        within.where("component <> home")
        .withColumn("x", place % F.col("gx"))
        .withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gy") - 1)))
    )
    right = within.withColumn("y", place % F.col("gy")).withColumn(
        "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gx") - 1))
    )
    cols = ["pivot", "x", "y", "doc_id", "component", "s"]
    lcols, rcols = [f"l_{c}" for c in cols], [f"r_{c}" for c in cols]
    more = (
        left.select(*cols)
        .toDF(*lcols)
        .groupBy(*lcols[:3])
        .cogroup(right.select(*cols).toDF(*rcols).groupBy(*rcols[:3]))
        .applyInPandas(_cross_links(percent), "a long, b long")
    )
    stars = first.select(F.col("id").alias("a"), F.col("component").alias("b")).where("a <> b")
    more = stored(more, "cross_links")
    if more.isEmpty():
        return first
    return stored(components(stars.union(more)), "components")
