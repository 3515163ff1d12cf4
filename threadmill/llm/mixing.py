"""Mixing sources to target weights by pivotal dependent rounding.

Sources, in code point order with null last, weigh 1, 2, 3, repeating, and
share the total size by weight; a target stops at three times its source's
size and the excess is shared among the others by weight. Each row of a source
is due target / source_size copies: the whole part is certain, the fraction is
rounded in pairs. A pair moves mass (fraction times size) at random, in the
direction and amount that keep both expectations, until one fraction is 0 or 1;
so a group ends with one fractional row at most and its mass unchanged.

Groups of about ``GROUP`` rows, dealt by a hash of doc_id, are rounded in
parallel, large rows first; their residuals meet ``FAN`` at a time in the next
level, up to one row a source, which goes to the nearer side. A hot source is
many groups. A source's taken size differs from its target by half a row's size
at most. Random numbers come from hashes, so reruns agree.

Defined results: null and empty texts have size 0 and take nothing; repeated
rows are units of their own; a source of size 0 has target 0; null doc_ids
are dealt like any other value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import BLANK, free_name, stored, text_bytes

GROUP = 4096
FAN = 256
MAX_COPIES = 3
SIZED = "doc_id long, source string, digest long, size long"
ROUNDED = "doc_id long, sid long, digest long, size long, whole long, p double, place long, bucket long"


def _word_counts(texts: list[bytes | None]) -> list[int]:
    out = []
    for t in texts:
        if t:
            blank = BLANK[np.frombuffer(t, np.uint8)]
            out.append(int(np.count_nonzero(blank[:-1] & ~blank[1:])) + int(not blank[0]))
        else:
            out.append(0)
    return out


def _sized(batches):
    for b in batches:
        sizes = pa.array(_word_counts(text_bytes(b)), pa.int64())
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "source", "digest")), sizes], ["doc_id", "source", "digest", "size"])


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, digest, size): the hash of the text and number of words of each row."""
    d = docs.select(*(F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("source", "string"), ("text", "string"))))
    return d.withColumn("digest", F.xxhash64("text")).mapInArrow(_sized, SIZED)


def targets(units: DataFrame) -> DataFrame:
    """(source, sid, rows, source_size, target), one row a source. Capped sources
    are a prefix in the order of cap over weight, so running sums find them."""
    s = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    s = s.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    s = s.withColumn("w", ((F.col("sid") - 1) % 3 + 1).cast("decimal(38,0)"))
    s = s.withColumn("cap", (F.col("source_size") * MAX_COPIES).cast("decimal(38,0)"))
    every = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("cap") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    s = s.withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), zero))
    s = s.withColumn("rest_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), zero))
    s = s.withColumn("capped", F.col("cap") * F.col("rest_w") <= F.col("rest") * F.col("w"))
    # what is left for the sources after the last capped one
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), zero)
    left_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(every)
    share = left.cast("double") * F.col("w").cast("double") / left_w.cast("double")
    s = s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share))
    return s.select("source", "sid", "rows", "source_size", "target")


def _settle(sizes: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> int:
    """Rounds ``p`` in place by pairwise transfers; the place left fractional, or -1."""
    open_ = -1
    draws = rng.random(len(p))
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if sizes[i] == 0:
            p[i] = 0.0
            continue
        if open_ < 0:
            open_ = i
            continue
        j, a, b = open_, sizes[open_], sizes[i]
        give = min(p[j] * a, (1.0 - p[i]) * b)  # j gives, i takes
        take = min(p[i] * b, (1.0 - p[j]) * a)  # i gives, j takes
        if draws[i] * (give + take) < take:
            j_done = p[j] * a <= (1.0 - p[i]) * b
            i_done = (1.0 - p[i]) * b <= p[j] * a
            pj, pi = p[j] - give / a, p[i] + give / b
            p[j], p[i] = (0.0 if j_done else pj), (1.0 if i_done else pi)
        else:
            i_done = p[i] * b <= (1.0 - p[j]) * a
            j_done = (1.0 - p[j]) * a <= p[i] * b
            pj, pi = p[j] + take / a, p[i] - take / b
            p[j], p[i] = (1.0 if j_done else pj), (0.0 if i_done else pi)
        left = [k for k in (j, i) if 0.0 < p[k] < 1.0]
        open_ = left[0] if left else -1
    return open_


def _pivotal(seed: int, level: int):
    def run(key, rows):
        # large rows first, among their like; ties in the order of a hash
        rows = rows.assign(n=-rows["size"]).sort_values(["n", "place", "p"], kind="stable").drop(columns="n")
        p = rows["p"].to_numpy().copy()
        state = xxhash.xxh3_64_intdigest(f"{seed}:{level}:{key[0]}:{key[1]}")
        _settle(rows["size"].to_numpy(), p, np.random.default_rng(state))
        return rows.assign(p=p)

    return run


def allocate(units: DataFrame, seed: int = 17) -> DataFrame:
    """(doc_id, source, digest, size, source_size, target, copies) for each row of
    ``units`` (doc_id, source, digest, size)."""
    # rows that repeat in all of these are numbered, so each has a place of its own
    fields = ["doc_id", "source", "digest", "size"]
    units = units.groupBy(*fields).agg(F.count(F.lit(1)).alias("times"))
    units = units.select(*fields, F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"))
    units = stored(units.withColumn("place", F.xxhash64("doc_id", "digest", "size", "nth", F.lit(seed))), "mix_units")
    t = stored(targets(units), "mix_targets")
    buckets = F.ceil(F.col("rows") / GROUP)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MAX_COPIES))))
    due = units.join(t, units["source"].eqNullSafe(t["source"])).select(
        "doc_id",
        "sid",
        "digest",
        "size",
        F.floor(F.coalesce(rate, F.lit(0.0)) + 1e-9).alias("whole"),
        F.coalesce(rate, F.lit(0.0)).alias("rate"),
        "place",
        F.pmod("place", buckets).alias("bucket"),
    )
    p = F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))
    due = due.withColumn("p", F.when(p < 1e-9, F.lit(0.0)).otherwise(p)).select("doc_id", "sid", "digest", "size", "whole", "p", "place", "bucket")

    level = 0
    done = []
    while True:
        now = stored(due.groupBy("sid", "bucket").applyInPandas(_pivotal(seed, level), ROUNDED), "mix_level")
        done.append(now.where("p = 0 or p = 1"))
        due = now.where("p > 0 and p < 1")
        most = due.agg(F.max("bucket")).first()[0]
        if not most:  # one residual a source, or none
            break
        due = due.withColumn("bucket", F.floor(F.col("bucket") / FAN))
        level += 1
    out = due.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))
    for d in done:
        out = out.union(d)
    return out.join(t, "sid").select(
        "doc_id",
        "source",
        "digest",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.col("p").cast("long")).alias("copies"),
    )


def mix_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """``docs`` with each row as often as the mix takes it. Rows that share
    doc_id, source and text are one unit here and come and go together."""
    names = [free_name(docs.columns, c) for c in ("mix_doc_id", "mix_source", "mix_digest", "mix_copies", "mix_turn")]
    units = sized(docs).groupBy("doc_id", "source", "digest").agg(F.sum("size").alias("size"))
    n = allocate(units, seed).where("copies > 0").select("doc_id", "source", "digest", "copies").toDF(*names[:4])
    same = docs["doc_id"].cast("long").eqNullSafe(n[names[0]]) & docs["source"].cast("string").eqNullSafe(n[names[1]])
    same = same & (F.xxhash64(docs["text"].cast("string")) == n[names[2]])
    turn = F.explode(F.sequence(F.lit(1).cast("long"), F.col(names[3]))).alias(names[4])
    return docs.join(n, same).select(*(docs[c] for c in docs.columns), turn).drop(names[4])
