"""Articles from a folder of page snapshots that keeps growing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.pages import MAX_BYTES, MAX_CHARS, read_articles
from ..sources.tables import as_responses


def stream_articles(
    spark: SparkSession, path: str, schema: str, max_bytes: int = MAX_BYTES,
    max_chars: int | None = MAX_CHARS,
) -> DataFrame:
    """``read_articles`` over every Parquet file that appears in ``path``; each file is read once."""
    arriving = spark.readStream.schema(schema).parquet(path)
    return read_articles(as_responses(arriving), max_bytes, max_chars)
