"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, bound: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, text, label`` of at most ``bound`` labelled rows that are not held out, the ones with
    the smallest hashes. Repeated labels of a document count once, with the larger value; labels or
    ids that are null don't count."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
        .groupBy(key).agg((F.max(label) > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64(key), key).limit(bound)
    )
    # ``known`` has at most ``bound`` narrow rows.
    rows = docs.select(key, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(known), key)
