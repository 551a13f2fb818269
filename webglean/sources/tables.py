"""Query lists and page snapshots as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def load_queries(
    df: DataFrame, query: str = "query", position: str | Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``queries(query_idx, query)`` from a text column, or from an array column of query lists.

    A text column needs ``position``, a column that says where each query stands; an array carries
    its own positions. ``keep`` names further columns to carry along, such as a batch id.
    """
    kept = [F.col(c) for c in keep]
    if isinstance(df.schema[query].dataType, T.ArrayType):
        return df.select(*kept, F.posexplode(query).alias("query_idx", "query"))
    if position is None:
        raise ValueError("a text column of queries needs a position column")
    at = F.col(position) if isinstance(position, str) else position
    return df.select(*kept, at.alias("query_idx"), F.col(query).alias("query"))


def as_responses(df: DataFrame) -> DataFrame:
    """Bring a snapshot table to ``responses``; one row per URL is expected.

    Columns that are missing count as: final URL = URL, status 200, no content type, no encoding, no
    transport error, no fetch time. A text ``html`` column becomes the UTF-8 ``body``.
    """
    have = set(df.columns)

    def pick(name: str, default: Column) -> Column:
        return (F.col(name) if name in have else default).alias(name)

    body = F.col("body") if "body" in have else F.encode(F.col("html"), "UTF-8")
    return df.select(
        "url",
        pick("final_url", F.col("url")),
        pick("status", F.lit(200)),
        pick("content_type", F.lit(None).cast("string")),
        pick("encoding", F.lit(None).cast("string")),
        body.alias("body"),
        pick("transport_error", F.lit(None).cast("string")),
        pick("fetched_at", F.lit(None).cast("timestamp")),
    )


def load_responses(spark: SparkSession, path: str) -> DataFrame:
    """``responses`` from a Parquet table of page snapshots."""
    return as_responses(spark.read.parquet(path))
