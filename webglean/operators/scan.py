"""Running aggregates over keys of any size.

A window keeps one key in one task. That is right for most keys and wrong for a key that holds a
third of a log. ``split_hot`` finds such keys; their rows are cut into ordered blocks, each block is
scanned on its own, and the totals of the blocks before it are added.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

# Rows of a block that are worth a task and a file of their own. Shorter blocks are only made while they
# are few: so many for each core.
BLOCK_ROWS = 200_000
BLOCKS_PER_CORE = 4

_PLACE, _PART, _BASE = "__place__", "__part__", "__base__"


class HotSplit(NamedTuple):
    cold: DataFrame
    hot: DataFrame | None
    blocks: int


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_hot(df: DataFrame, keys: list[str], hot_rows: int) -> HotSplit:
    """Rows of keys with more than ``hot_rows`` rows apart from the rest. Runs one counting job.

    ``blocks`` is the number of blocks of ``hot_rows`` rows. Where these are so short that tasks and files
    would take longer than the rows in them, it is that of longer ones.
    """
    hot_keys = df.groupBy(*keys).count().filter(F.col("count") > hot_rows)
    total = hot_keys.agg(F.sum("count")).first()[0]
    if total is None:
        return HotSplit(df, None, 0)
    # At most (all rows / hot_rows) keys can be hot, so this side is small by construction.
    listed = F.broadcast(hot_keys.select(*keys))
    few = BLOCKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    matches = same_key(df, listed, keys)
    return HotSplit(
        df.join(listed, matches, "left_anti"),
        df.join(listed, matches, "left_semi"),
        min(-(-total // hot_rows), max(-(-total // BLOCK_ROWS), few)),
    )


def ordered_blocks(df: DataFrame, keys: list[str], order: list[str], blocks: int) -> DataFrame:
    """Add ``_block``: ranges of about equal size along ``keys`` and ``order``.

    Range borders come from sampling, so the result is written to the shared checkpoint folder:
    every reader, also after a lost executor, sees the same blocks.
    """
    ranged = df.repartitionByRange(blocks, *keys, *order)
    return cut_lineage(ranged.withColumn("_block", F.spark_partition_id()))


def numbered(df: DataFrame, order: list[str | Column], to: str = "position") -> DataFrame:
    """Add dense numbers from 1 along ``order``, without one task that sees all rows.

    Rows are dealt out in ranges of ``order`` and sorted there; the sorted ranges are written to the
    shared folder, as their borders come from sampling. One row a range gives the rows before it.
    All columns move, so pass narrow rows. Rows equal in ``order`` share a range: name enough columns.
    """
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the number of the range above bit 33, and the place in it below.
    written = cut_lineage(sorted_ranges.withColumn(_PLACE, F.monotonically_increasing_id()))
    part = F.shiftright(_PLACE, 33)
    sizes = written.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(_BASE))
    # One row a range: as many as the shuffle has partitions.
    placed = written.join(F.broadcast(bases), part == F.col(_PART))
    place = F.col(_PLACE).bitwiseAND((1 << 33) - 1)
    return placed.withColumn(to, F.col(_BASE) + place + 1).select(*df.columns, to)
