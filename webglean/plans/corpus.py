"""Research: topics to a cited corpus with full text."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions.limits import DEFAULT_RESULTS, max_results_error
from ..functions.text import is_blank
from ..operators.pages import DEFAULT_USER_AGENT, MAX_BYTES, MAX_CHARS, extract_articles
from ..operators.requests import validate_max_results, validate_queries
from ..operators.research import research, research_summary
from ..operators.search import search_batch
from ..session import cut_lineage


class ResearchReport(NamedTuple):
    summary: DataFrame
    sources: DataFrame


def research_report(
    topics: DataFrame, corpus: DataFrame, responses: DataFrame | None = None,
    robots: DataFrame | None = None, k: int | str = DEFAULT_RESULTS, fetch_full: bool = True,
    max_chars: int | None = MAX_CHARS, mode: str = "fail", user_agent: str = DEFAULT_USER_AGENT,
    max_bytes: int = MAX_BYTES,
) -> ResearchReport:
    """``topics(query_idx, query)``: search each, fetch what was found, join the text back.

    With ``mode="capture"`` a bad topic has no sources, and a hit that is no http(s) URL gets the
    error of its row; every other topic goes on. ``k`` is a number or a column of ``topics``.
    """
    if fetch_full and responses is None:
        raise ValueError("fetch_full needs responses")
    checked = validate_queries(topics, mode)
    if isinstance(k, str):
        checked = validate_max_results(checked, k) if mode == "fail" else checked.withColumn(
            "error", F.coalesce("error", max_results_error(F.col(k), topics.schema[k].dataType))
        )
    good = checked if mode == "fail" else checked.filter(F.col("error").isNull())
    # Used for the URLs, the citations and the counts. Written once, so the corpus is searched once.
    hits = cut_lineage(search_batch(good, corpus, k)).withColumnRenamed("query_idx", "topic")
    articles = None
    if fetch_full:
        urls = hits.select("url", F.col("rank").alias("position"))
        if not urls.filter(~is_blank(F.col("url"))).isEmpty():
            articles = extract_articles(
                urls, responses, robots, user_agent, max_bytes, max_chars, mode=mode
            )
    # Read by the report and by its summary. Written once, so the pages are read once.
    sources = cut_lineage(research(hits, articles, fetch_full))
    asked = checked.select(F.col("query_idx").alias("topic"))
    return ResearchReport(research_summary(asked, sources), sources)
