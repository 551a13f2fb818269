"""Rows whose hash is in a list of any length, kept before anything dear is done with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .sizing import is_small

# Hashes up to this many are sent along as they are: about 25 MB in every executor.
LISTED_HASHES = 1_000_000
# Beyond that a Bloom filter of fixed size is: so many bitmaps of 4 KB, 32 MB together.
BITMAPS = 8192
_BITS = 32_768
_PROBES = 3


def keep_listed(rows: DataFrame, key: Column, hashes: DataFrame, few: bool | None = None) -> DataFrame:
    """Rows whose 64-bit ``key`` is in ``hashes(_hash)``, and few others where the list is long.

    The rows are not shuffled. Join exactly behind what this saves. ``few`` tells whether the list has
    at most ``LISTED_HASHES`` rows, where the caller knows.
    """
    few = is_small(hashes, LISTED_HASHES) if few is None else few
    marked = rows.withColumn("_hash", key)
    if few:
        return marked.join(F.broadcast(hashes.distinct()), "_hash", "left_semi").drop("_hash")
    bitmaps = hashes.select(
        _bitmap(F.col("_hash")).alias("_bitmap"), F.explode(_bits(F.col("_hash"))).alias("_bit")
    ).groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_set"))
    probed = marked.withColumn("_bitmap", _bitmap(F.col("_hash"))).join(F.broadcast(bitmaps), "_bitmap")
    found = F.forall(_bits(F.col("_hash")), lambda bit: _is_set(F.col("_set"), bit))
    return probed.filter(found).select(*rows.columns)


def _bitmap(value: Column) -> Column:
    return F.pmod(value, F.lit(BITMAPS))


def _bits(value: Column) -> Column:
    """Places in a bitmap, from hashes of the hash: those of one bitmap differ in all else."""
    return F.array(*[F.pmod(F.xxhash64(value, F.lit(n)), F.lit(_BITS)) for n in range(_PROBES)])


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1
