"""Connected components of an edge table in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction round. Large star: every node links its larger neighbours
    to its smallest one. Small star: it links its smaller neighbours, and
    itself, to the smallest. The smallest neighbours are stored first, so the
    join has plain shuffles on both sides and Spark can split a hot node."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "stars")
    if large:
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select("a", F.col("m").alias("b")))
    return stored(out.where("a <> b").distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): for each id in ``edges`` (a, b) the smallest id it reaches."""
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        edges = _star(_star(edges, large=True), large=False)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # stars only now: every larger id has one edge, to the smallest
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
