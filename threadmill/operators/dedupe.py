"""Duplicate and near-duplicate grouping of texts (I12 re-aim).

Exact duplicates: group by sha256 of the normalised text.

Near duplicates are linked where the sets of their word shingles have a Jaccard
similarity of ``percent`` or more, and clusters are the connected components of
these links:

1. Texts of equal words become one representative (a partial aggregate).
2. MinHash signatures are cut into bands; equal bands put texts into a bucket. A
   linked pair of similarity 0.8 shares none of 25 bands of 4 with a chance of 2e-6.
3. Every text of a bucket is compared with the bucket's smallest id, on the full
   sets. Links found so far give components.
4. A text outside the component of its bucket's smallest id is compared with
   the bucket's texts of other components, again on the full sets. Texts already
   in one component are never compared, so a bucket of near copies costs one
   comparison a member, not one a pair.

Signatures are made in one pass over the texts and stored without the sets; sets are
made again for the texts that share a bucket with another text, and only these are shuffled.

Rows of a bucket, copy group or centre that holds more than a thousandth of all rows
are not gathered by that key: it is looked up from a broadcast of at most 1,000
keys, or salted (``hot_keys``).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from .components import connected_components, written, written_sum
from .hot_keys import hot_keys, lookup, repeated, salted, splits_of
from .layout import spread

BANDS, ROWS = 25, 4
#: Hashes whose permutations are computed at once.
SLICE = 1 << 18


def normalized_hash(col: str) -> "F.Column":
    return F.sha2(F.lower(tx.strip(F.col(col))), 256)


def exact_dup_groups(df: DataFrame, id_col: str, text_col: str, min_size: int = 2) -> DataFrame:
    """Groups of identical (stripped, lower-cased) texts with at least
    ``min_size`` members: ``text_hash, n_docs, first_id``."""
    return (df.groupBy(normalized_hash(text_col).alias("text_hash"))
            .agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.col(id_col)).alias("first_id"))
            .where(F.col("n_docs") >= min_size))


def shingle_sets(df: DataFrame, id_col: str, text_col: str, shingle: int = 5) -> DataFrame:
    """``id, words, hashes``: a digest of the words in order, and the distinct 64-bit
    hashes of the shingles (of the whole sequence, where it is shorter). Texts
    without words have no row."""
    # Tokens and their hashes are materialised as columns first: an expression used
    # inside a lambda would be re-evaluated for every element.
    base = spread(df).select(F.col(id_col).alias("id"), tx.tokens(F.col(text_col)).alias("_toks")).where(F.size("_toks") > 0)
    base = base.select("id", F.sha2(F.array_join("_toks", " "), 256).alias("words"), F.transform("_toks", lambda t: F.xxhash64(t)).alias("_h"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_h") - shingle + 1, F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("_h", i, shingle)))
    return base.select("id", "words", F.array_distinct(hashes).alias("hashes"))


def _signatures(hashes: np.ndarray, starts: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Minima of ``count`` multiply-add permutations (odd factors, mod 2**64) by set."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2)
    out = np.empty((len(starts), count), np.uint64)
    for i in range(count):
        x = hashes * factor[i] + shift[i]
        x ^= x >> np.uint64(32)
        out[:, i] = np.minimum.reduceat(x * factor[i], starts)
    return out


def _banded(seed: int):
    def run(batches):
        rng = np.random.default_rng(seed + 1)
        factor = rng.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for b in batches:
            ends = b.column("hashes").offsets.to_numpy()
            i = 0
            while i < b.num_rows:  # sets are worked on in slices of bounded size, one set at least
                j = max(int(np.searchsorted(ends, ends[i] + SLICE, "right")) - 1, i + 1)
                part = b.column("hashes").slice(i, j - i)
                sig = _signatures(part.flatten().to_numpy().view(np.uint64), ends[i:j] - ends[i], BANDS * ROWS, seed)
                band = (sig.reshape(j - i, BANDS, ROWS) * factor).sum(2, dtype=np.uint64)
                band = (band ^ (band >> np.uint64(29))) * factor[0] + np.arange(BANDS, dtype=np.uint64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(band.ravel().view(np.int64)), BANDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("id", "words")), lists], ["id", "words", "bands"])
                i = j

    return run


def signatures(sets: DataFrame, seed: int = 11) -> DataFrame:
    """``id, words, bands``: the bands of a set's MinHash signature; narrow rows without the set."""
    schema = T.StructType([sets.schema["id"], sets.schema["words"], T.StructField("bands", T.ArrayType(T.LongType()))])
    return sets.select("id", "words", "hashes").mapInArrow(_banded(seed), schema)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have ``percent`` similarity or more. Pairs that
    the set sizes rule out bring no sets together; an id in very many pairs is salted."""
    size = F.size("hashes")
    sizes = sets.select("id", size.alias("n"))
    pairs = pairs.join(sizes.toDF("a", "_na"), "a").join(sizes.toDF("b", "_nb"), "b")
    fits = 100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb")
    pairs = written(pairs.where(fits).select("a", "b").distinct(), "pairs")
    degree, total = written_sum(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "degrees", "n")
    splits = splits_of(degree, "b", total)
    left = salted(pairs, "b", "a", splits).join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("_x")), "a")
    right = repeated(sets.select(F.col("id").alias("b"), F.col("hashes").alias("_y")), "b", splits)
    both = left.join(right, ["b", "_salt"]).withColumn("_i", F.size(F.array_intersect("_x", "_y")))
    return both.where(100 * F.col("_i") >= percent * (F.size("_x") + F.size("_y") - F.col("_i"))).select("a", "b")


def _copies(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of texts of equal words to the smallest id, and the signatures of these."""
    groups = sets.groupBy("words").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    groups, total = written_sum(groups, "copies", "n")
    many = groups.where("n > 1").select("words", "rep")
    links = lookup(sets.select("id", "words"), many, "words", hot_keys(groups, "words", total))
    links = links.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    # by (words, id), so a large copy group is spread over its ids
    reps = sets.join(groups.select("words", F.col("rep").alias("id")), ["words", "id"], "left_semi")
    return links, reps.select("id", "words", "bands").dropDuplicates(["id", "words"])


def near_dup_links(reps: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = 80) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``reps`` (id, words, bands)
    of ``percent`` similarity or more. ``sets_of(ids)`` gives the sets (id, words, hashes) of
    some ids: only those that share a bucket are asked for."""
    rows = written(reps.select("id", F.explode("bands").alias("bucket")), "buckets")
    buckets = rows.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets, total = written_sum(buckets, "pivots", "n")
    hot = hot_keys(buckets, "bucket", total)
    members = written(lookup(rows, buckets.select("bucket", "pivot"), "bucket", hot), "members")
    sets = sets_of(written(members.select("id").distinct(), "met")).join(reps.select("id", "words"), ["id", "words"], "left_semi")
    reps = written(sets.dropDuplicates(["id", "words"]).select("id", "hashes"), "sets")
    first = members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = written(confirmed(first, reps, percent), "confirmed")
    label = written(connected_components(links), "labels")
    # an id stands in one bucket a band at most, so neither join has a hot key
    homes = buckets.join(label.toDF("pivot", "_home"), "pivot", "left").select("bucket", F.coalesce("_home", "pivot").alias("centre"))
    mine = members.join(label.toDF("id", "_mine"), "id", "left").select("id", "bucket", F.coalesce("_mine", "id").alias("mine"))
    known = written(lookup(mine, written(homes, "homes"), "bucket", hot), "labelled")
    outside = known.where(F.col("mine") != F.col("centre")).select("bucket", F.col("id").alias("a"), F.col("mine").alias("la"))
    inside = known.select("bucket", F.col("id").alias("b"), F.col("mine").alias("lb"))
    splits = splits_of(buckets, "bucket", total)
    inside = salted(inside.join(outside.select("bucket").distinct(), "bucket", "left_semi"), "bucket", "b", splits)
    pairs = repeated(outside, "bucket", splits).join(inside, ["bucket", "_salt"]).where("la <> lb")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars = label.select(F.col("id").alias("a"), F.col("label").alias("b"))
    return stars.unionByName(confirmed(pairs, reps, percent))


def near_dup_clusters(df: DataFrame, id_col: str, text_col: str, shingle: int = 5, percent: int = 80,
                      min_size: int = 2) -> DataFrame:
    """``id, cluster_id, cluster_size`` for texts in near-duplicate clusters of at least
    ``min_size`` members (cluster id = smallest member id). Rows with a null id
    take no part; texts of one id are in one cluster."""
    if percent < 80:
        raise ValueError("the bands are laid out for a similarity of 80 percent or more")
    known = df.where(F.col(id_col).isNotNull())
    copies, reps = _copies(written(signatures(shingle_sets(known, id_col, text_col, shingle)), "signatures"))
    reps = written(reps, "reps")

    def sets_of(ids: DataFrame) -> DataFrame:
        return shingle_sets(known.join(ids.select(F.col("id").alias(id_col)), id_col, "left_semi"), id_col, text_col, shingle)

    comps = connected_components(copies.unionByName(near_dup_links(reps, sets_of, percent)))
    sizes = comps.groupBy("label").agg(F.count(F.lit(1)).alias("cluster_size")).where(F.col("cluster_size") >= min_size)
    sizes, total = written_sum(sizes, "cluster_sizes", "cluster_size")
    out = lookup(comps, sizes, "label", hot_keys(sizes, "label", total, "cluster_size"))
    return out.select(F.col("id").alias(id_col), F.col("label").alias("cluster_id"), "cluster_size")


def largest_clusters(clusters: DataFrame, n: int = 20) -> DataFrame:
    """Report of the ``n`` largest clusters, ranked by size, then id."""
    sizes = clusters.groupBy("cluster_id").agg(F.max("cluster_size").alias("cluster_size"))
    top = sizes.orderBy(F.desc("cluster_size"), "cluster_id").limit(n)
    ranked = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("cluster_size")).alias("s"), "cluster_id"))).alias("all"))
    rows = ranked.select(F.posexplode("all").alias("at", "c"))
    return rows.select((F.col("at") + 1).cast("int").alias("rank"), "c.cluster_id", (-F.col("c.s")).alias("cluster_size"))
