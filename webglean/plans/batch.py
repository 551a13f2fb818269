"""A search batch: many queries, one merged report."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions.limits import DEFAULT_RESULTS, max_results_error
from ..functions.text import is_blank
from ..operators.requests import validate_max_results, validate_queries
from ..operators.results import batch_summary, merge_results, query_stats
from ..operators.search import search_batch
from ..session import cut_lineage


# Fixed value: the error of a batch without queries.
NO_QUERIES = "queries list is empty"


class BatchReport(NamedTuple):
    queries: DataFrame
    results: DataFrame
    summary: DataFrame


def search_report(
    queries: DataFrame, corpus: DataFrame, k: int | str = DEFAULT_RESULTS, dedupe: bool = True,
    mode: str = "fail",
) -> BatchReport:
    """Check, search, merge and count. ``mode="capture"`` keeps bad queries as error rows.

    No query at all raises ValueError.
    """
    if queries.isEmpty():
        raise ValueError(NO_QUERIES)
    checked = validate_queries(queries, mode)
    if mode == "fail":
        checked = checked.withColumn("error", F.lit(None).cast("string"))
    if isinstance(k, str):
        kind = queries.schema[k].dataType
        if mode == "fail":
            checked = validate_max_results(checked, k)
        else:
            checked = checked.withColumn("error", F.coalesce("error", max_results_error(F.col(k), kind)))
    # The ranked rows feed all three reports. Written once, so the corpus is searched once.
    hits = cut_lineage(search_batch(checked.filter(is_blank(F.col("error"))), corpus, k))
    merged = merge_results(hits, dedupe)
    outcomes = checked.select("query_idx", "query", "error")
    return BatchReport(query_stats(outcomes, hits), merged, batch_summary(outcomes, merged))
