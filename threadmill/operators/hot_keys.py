"""Joins on keys that may hold a large share of all rows.

A key is hot when it holds more than one in ``SHARE`` of the rows, so there are
``SHARE`` hot keys at most whatever the size of the input: their list is
broadcast, and their rows are never gathered by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def hot_keys(counts: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """The hot keys of ``counts`` (key, n): fewer than ``SHARE`` rows."""
    return counts.where(F.col(n) * SHARE > total).select(key)


def lookup(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``rows`` inner joined with ``table`` (one row a key): the hot keys' rows of
    ``table`` are broadcast and the rows they belong to stay where they are."""
    few = F.broadcast(table.join(F.broadcast(hot), key, "left_semi"))
    rest = rows.join(F.broadcast(hot), key, "left_anti")
    return rows.join(few, key).unionByName(rest.join(table, key))


def salted(rows: DataFrame, key: str, by: str, splits: DataFrame) -> DataFrame:
    """``rows`` with ``_salt``: 0, or for the keys of ``splits`` (key, parts; few
    rows) one of ``parts`` by the hash of ``by``."""
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    out = rows.join(F.broadcast(splits.withColumnRenamed("parts", "_parts")), key, "left")
    return out.withColumn("_salt", F.pmod(F.xxhash64(by), parts)).drop("_parts")


def repeated(rows: DataFrame, key: str, splits: DataFrame) -> DataFrame:
    """``rows`` once for each salt of their key: the other side of ``salted``."""
    parts = F.coalesce(F.col("_parts"), F.lit(1)).cast("long")
    out = rows.join(F.broadcast(splits.withColumnRenamed("parts", "_parts")), key, "left")
    return out.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")


def splits_of(counts: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """(key, parts) of the hot keys: parts of about one in ``SHARE`` of the rows each."""
    hot = counts.where(F.col(n) * SHARE > total)
    return hot.select(key, F.ceil(F.col(n) * SHARE / max(total, 1)).alias("parts"))
