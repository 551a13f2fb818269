"""Search payloads: JSON text to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_FIELDS = ("url", "title", "publishedDate", "text")


def _has_results(json: Column) -> Column:
    """True for a JSON object with the key ``results``, whatever its value."""
    return F.coalesce(F.array_contains(F.json_object_keys(json), "results"), F.lit(False))


def parse_payloads(outcomes: DataFrame) -> DataFrame:
    """``hits(query_idx, rank, url, title, publishedDate, text)`` from search answers.

    ``outcomes(query_idx, payload)`` or ``outcomes(query_idx, structured, content)`` with ``content``
    an array of text blocks. The structured field wins when it has the key ``results``, else the
    first text block that has it. An item that is no object keeps its rank with null fields.
    """
    if "payload" in outcomes.columns:
        structured, blocks = F.col("payload"), F.array().cast("array<string>")
    else:
        structured = F.col("structured")
        blocks = F.coalesce(F.col("content"), F.array().cast("array<string>"))
    fitting = F.filter(blocks, _has_results)
    chosen = F.when(_has_results(structured), structured).otherwise(F.get(fitting, F.lit(0)))
    items = F.from_json(chosen, "results ARRAY<VARIANT>")["results"]
    exploded = outcomes.select("query_idx", F.posexplode(items).alias("_at", "_item"))
    return exploded.select(
        "query_idx",
        (F.col("_at") + 1).alias("rank"),
        *[
            F.try_variant_get("_item", f"$.{name}", "string").alias(name)
            for name in _FIELDS
        ],
    )
