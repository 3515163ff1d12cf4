"""Snippet blocks and prompt-ready rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as tx
from .hooks import once_a_worker


def snippet_line(text_col: str = "chunk_text", link_col: str = "permalink") -> Column:
    """``- {text with newlines as spaces} (link: {link})``."""
    return F.concat(F.lit("- "), tx.newline_to_space(F.coalesce(F.col(text_col), F.lit(""))),
                    F.lit(" (link: "), F.coalesce(F.col(link_col), F.lit("")), F.lit(")"))


def snippet_block(ranked: DataFrame, qid: str = "query_id", rank_col: str = "rerank_rank",
                  text_col: str = "chunk_text", link_col: str = "permalink") -> DataFrame:
    """Per query, the snippet lines joined by newline in rank order.

    The group per query is bounded by the rerank cut (top-n), so the ordered
    list stays small.
    """
    lines = ranked.select(F.col(qid), F.col(rank_col).alias("_r"), snippet_line(text_col, link_col).alias("_line"))
    return lines.groupBy(qid).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_line"))), lambda s: s["_line"]), "\n").alias("snippets"),
        F.count(F.lit(1)).alias("n_snippets"),
    )


def _printf_template(template: str, names: list[str]) -> str:
    """'{a} x {b}' -> '%1$s x %2$s' (single-pass fill, like str.format)."""
    out = template.replace("%", "%%")
    for i, n in enumerate(names, start=1):
        out = out.replace("{" + n + "}", f"%{i}$s")
    if re.search(r"\{[a-z_]+\}", out):
        raise ValueError("template has unfilled placeholders")
    return out


def fill(template: str, **values: Column) -> Column:
    """Fill ``{name}`` placeholders from columns in one pass: text coming from
    the data is never re-expanded."""
    names = list(values)
    return F.format_string(_printf_template(template, names), *[values[n].cast("string") for n in names])


def messages(system: Column, user: Column) -> Column:
    return F.array(F.struct(F.lit("system").alias("role"), system.alias("content")),
                   F.struct(F.lit("user").alias("role"), user.alias("content")))


def prompt_ideas(blocks: DataFrame, n: int = C.DEFAULT_IDEAS) -> DataFrame:
    """Idea-generation prompt per query."""
    user = fill(C.IDEA_GEN_USER, n=F.lit(n), snippets=F.col("snippets"))
    return blocks.select("*", F.lit(C.SYSTEM_IDEAS).alias("system_prompt"), user.alias("user_prompt")).withColumn(
        "messages", messages(F.col("system_prompt"), F.col("user_prompt")))


def prompt_pains(blocks: DataFrame, topic: Column, subs: Column, period: Column) -> DataFrame:
    """Pain-mining prompt per query."""
    user = fill(C.PAIN_MINING_USER, topic=topic, subs=subs, period=period, snippets=F.col("snippets"))
    return blocks.select("*", F.lit(C.PAIN_MINING_SYSTEM).alias("system_prompt"), user.alias("user_prompt")).withColumn(
        "messages", messages(F.col("system_prompt"), F.col("user_prompt")))


def prompt_scoring(ideas: DataFrame, ideas_col: str = "ideas") -> DataFrame:
    """Scoring prompt per row of idea text."""
    return ideas.withColumn("user_prompt", fill(C.SCORING_USER, ideas=F.col(ideas_col)))


def complete_with(prompts: DataFrame, factory: Callable, schema: str = "query_id long, completion string") -> DataFrame:
    """Completion hook contract (L3): ``factory()`` gives ``completion(pandas.DataFrame)
    -> pandas.DataFrame``, built once a Python worker and applied per Arrow batch
    with ``mapInPandas``. No model ships with the library."""
    model = once_a_worker(factory)

    def run(batches):
        completion = model()
        for pdf in batches:
            yield completion(pdf)

    return prompts.mapInPandas(run, schema)
