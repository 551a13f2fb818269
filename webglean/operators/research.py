"""Search rows joined with article text: one cited corpus per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import blank_to_null, is_blank


def research(hits: DataFrame, articles: DataFrame | None, fetch_full: bool = True) -> DataFrame:
    """``(topic, rank, url, title, publishedDate, snippet, text, fetchError)``.

    ``hits(topic, rank, url, title, publishedDate, text)`` with unique ``rank`` per topic,
    ``articles(url, title, text, error)`` with unique ``url``. Where a topic lists a URL more than
    once, only the last row gets the article. Every snippet and citation stays.

    The last row per (topic, url) is a pre-aggregated maximum, not a window. It goes back to the
    rows by (topic, rank), which is unique, so no topic and no URL gathers in one task there. The
    article lookup by URL has unique articles; Spark splits a popular URL's rows if they are many.
    """
    sources = hits.select(
        "topic", "rank", "url", "title", "publishedDate", F.col("text").alias("snippet")
    )
    if not fetch_full or articles is None:
        return sources.withColumns(
            {"text": F.lit(None).cast("string"), "fetchError": F.lit(None).cast("string")}
        )
    last = (
        hits.filter(~is_blank(F.col("url")))
        .groupBy("topic", "url")
        .agg(F.max("rank").alias("rank"))
        .join(
            articles.select(
                "url", F.col("title").alias("_title"), F.col("text").alias("_text"),
                F.col("error").alias("_error"), F.lit(True).alias("_found"),
            ),
            "url",
        )
        .drop("url")
    )
    failed = ~is_blank(F.col("_error"))
    joined = sources.join(last, ["topic", "rank"], "left")
    found_title = F.when(F.col("_found") & ~failed, blank_to_null(F.col("_title")))
    return joined.select(
        "topic",
        "rank",
        "url",
        F.coalesce(blank_to_null(F.col("title")), found_title, F.col("title")).alias("title"),
        "publishedDate",
        "snippet",
        F.when(F.col("_found") & ~failed, F.col("_text")).alias("text"),
        F.when(F.col("_found") & failed, F.col("_error")).alias("fetchError"),
    )


def research_summary(topics: DataFrame, sources: DataFrame) -> DataFrame:
    """``(topic, sourceCount, fetched, errorCount)``, with zeros for a topic without sources."""
    counts = sources.groupBy("topic").agg(
        F.count(F.lit(1)).alias("sourceCount"),
        F.count("text").alias("fetched"),
        F.count_if(~is_blank(F.col("fetchError"))).alias("errorCount"),
    )
    joined = topics.select("topic").join(counts, "topic", "left")
    return joined.select(
        "topic",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("sourceCount", "fetched", "errorCount")],
    )
