"""Connected components by contraction to stars.

A round hooks every node's larger neighbours to its smallest neighbour (large
star), then its smaller neighbours and itself to the smallest (small star). Paths
halve with every round, so a chain of n nodes takes about log2 n rounds, and
what is left are stars around the smallest id of each component. Each step is
written to the shared scratch folder, which cuts lineage; nothing stays cached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path
from .hot_keys import hot_keys, lookup


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_sum(df: DataFrame, name: str, col: str) -> tuple[DataFrame, int]:
    """``written``, and the sum of ``col``, observed while it is written."""
    path, seen = scratch_path(df.sparkSession, name), Observation()
    df.observe(seen, F.sum(col).alias("total")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["total"] or 0


def _hooked(links: DataFrame, total: int, larger: bool) -> DataFrame:
    """Edges from the (larger, or all) neighbours of each node to the smallest of
    the node and its neighbours; a node of very many links is looked up."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    to = least.select("a", F.least("a", "m").alias("m"))
    rows = links.where("b > a") if larger else links
    out = lookup(rows, to, "a", hot_keys(least, "a", total)).select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = out if larger else out.unionByName(to.select("a", F.col("m").alias("b")))
    return written(out.where("a <> b").distinct(), "links")


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges, and of nodes that keep them from being stars: those with two
    edges to a smaller id, or with one and an edge from a larger id."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    n, odd = nodes.agg(F.sum("up"), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
    return n or 0, odd


def connected_components(edges: DataFrame, rounds: list | None = None) -> DataFrame:
    """(id, label): for each id of ``edges`` (a, b) the smallest id it is linked
    with. ``rounds``, where given, collects the number of edges after each round."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "links")
    n, odd = _state(edges)
    while odd:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _hooked(both, 2 * n, larger=True)
        edges = _hooked(edges, n, larger=False)
        n, odd = _state(edges)
        if rounds is not None:
            rounds.append(n)
    centres = edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(centres)
