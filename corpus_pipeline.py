"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``docs``; extra columns pass through whatever their names.

Defined results: null and empty texts fail the quality rules and go; rows with a
null doc_id are in no group of near duplicates and stay; of rows that repeat a
doc_id near-dedup keeps the one of the smallest text hash; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm.bpe import encode_documents
from threadmill.llm.common import free_name, prepare, stored
from threadmill.llm.line_dedup import dedup_lines
from threadmill.llm.minhash_dedup import near_duplicates
from threadmill.llm.mixing import mix_documents
from threadmill.llm.quality_rules import keep_quality
from threadmill.llm.queries import table, vocabulary_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepare(spark)
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three documents or more share."""
    prepare(spark)
    out, *counts = dedup_lines(docs)
    return out.drop(*counts)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates,
    over the 4-word shingles of operator 1."""
    prepare(spark)
    mine, h, n = (free_name(docs.columns, c) for c in ("kept_doc_id", "text_hash", "rows"))
    kept = near_duplicates(docs, words=4).where(F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(mine))
    found = docs.join(kept, docs["doc_id"].cast("long") == kept[mine], "left_semi")
    # few ids repeat: only their rows are brought together
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias(n), F.min(F.xxhash64("text")).alias(h)).where(F.col(n) > 1)
    again = stored(again.select(F.col("doc_id").alias(mine), h), "repeated_ids")
    single = found.join(again, found["doc_id"] == again[mine], "left_anti")
    least = found.join(again, (found["doc_id"] == again[mine]) & (F.xxhash64(found["text"]) == again[h]), "left_semi")
    return single.union(least.dropDuplicates(["doc_id"])).union(docs.where(F.col("doc_id").isNull()))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    prepare(spark)
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number and the ids of their tokens."""
    prepare(spark)
    out, _, _, decoded = encode_documents(docs, vocabulary_file())
    return out.drop(decoded)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: The forest, the rounding and the vocabulary are beyond SQL; tests/llm checks
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
