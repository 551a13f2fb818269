"""Size checks that decide between a broadcast and a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows a table may have to be sent to every executor. Used for narrow rows only (an id and a short
# text), so the bound is a few dozen megabytes.
BROADCAST_ROWS = 200_000


def count_up_to(df: DataFrame, limit: int) -> int | None:
    """The row count if it is at most ``limit``, else None. Tasks stop at the limit; a number comes back."""
    n = df.select().limit(limit + 1).count()
    return n if n <= limit else None


def is_small(df: DataFrame, limit: int) -> bool:
    return count_up_to(df, limit) is not None
