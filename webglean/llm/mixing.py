"""Mixing sources to target weights by capped water-filling.

A source's size is the number of words of its texts. The sizes of all sources, or a stated number of
words, are shared out by weight. A source whose share exceeds ``epochs`` times its size is clamped
there, and what is left goes to the others by weight, until no share is above its cap. The level of
the water (words left over weights left) is all that passes from round to round, so the sources stay
a table of any length.

Every document is taken as often as whole times its source's size fits into the target. What remains
is filled by documents in the order of a seeded draw until half of the next one would be too much:
the words taken miss the target by half of one document at most. The document where a source stops is
found by narrowing the draws down, ``DIGITS`` digits at a time, over pre-aggregated sums; no source is
ever sorted or gathered.

Null and empty texts have size 0 and are never taken; a null source is a source. Sources without a
weight, or with one that is null or not above 0, get the target 0. Rows equal in id and text share a
draw, so they are taken alike. Rows and their other columns stay as they are; columns named like
those added are replaced. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.scan import numbered
from ..operators.sizing import BROADCAST_ROWS, is_small
from ..session import cut_lineage, forget

EPOCHS = 3
# Hexadecimal digits of the draw that one pass narrows down, and the rows it may leave to a window.
DIGITS = 3
LAST_ROWS = 10_000
_DRAW_DIGITS = 32

_WORD = r"[^\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The number of words; every word becomes one letter, and the rest goes."""
    letters = F.translate(F.regexp_replace(text.cast("string"), _WORD, "w"), _SPACES, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def draw(seed: int, key: str = "doc_id", text: str = "text") -> Column:
    """A hexadecimal text that orders rows at random, the same in every run."""
    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    content = F.coalesce(F.md5(F.col(text).cast("string")), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), named, F.lit(":"), content))


def cycled_weights(docs: DataFrame, weights: tuple[int, ...], source: str = "source") -> DataFrame:
    """``source, weight``: the weights in turn to the sources by code point, null last."""
    names = docs.select(F.col(source).cast("string").alias("source")).distinct()
    placed = numbered(names, [F.col("source").asc_nulls_last()])
    turn = F.pmod(F.col("position") - 1, F.lit(len(weights))).cast("int")
    return placed.select("source", F.get(F.array(*map(F.lit, weights)), turn).alias("weight"))


def targets(sizes: DataFrame, epochs: int = EPOCHS, total: int | None = None) -> DataFrame:
    """Add ``target`` to ``sizes(source, source_size, weight)``. ``total`` defaults to all sizes."""
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0)
    cap = (F.col("source_size") * epochs).cast("double")
    sums = sizes.agg(F.sum("source_size"), F.sum(weight)).first()
    whole = sums[0] if total is None else total
    left, weights = whole, sums[1]
    if not weights:
        return sizes.withColumn("target", F.lit(0.0))
    while True:
        share = weight.cast("double") * float(left) / float(weights)
        row = sizes.agg(
            F.coalesce(F.sum(F.when(share > cap, F.col("source_size") * epochs)), F.lit(0)),
            F.sum(F.when(share > cap, 0).otherwise(weight)),
        ).first()
        # The level only rises, so what is clamped stays clamped, and weights get fewer until it stands.
        if not 0 < row[1] < weights:
            break
        left, weights = whole - row[0], row[1]
    return sizes.withColumn("target", F.least(cap, share))


def _stops(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, last_draw``: the last draw of every source that fills its remaining words."""
    spread = Window.partitionBy("source").orderBy("start")
    states = [plan.select("source", "rest", F.lit(0).cast("long").alias("before"))]
    inside, width, most = sized, 0, LAST_ROWS + 1
    while most > LAST_ROWS and width < _DRAW_DIGITS:
        width = min(width + DIGITS, _DRAW_DIGITS)
        sums = inside.groupBy("source", F.substring("draw", 1, width).alias("start")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
        )
        ends = _by_source(sums, states[-1].select("source", "rest", "before")).withColumn(
            "end", F.col("before") + F.sum("words").over(spread)
        )
        # A source's remainder is below its size, so one beginning of a draw crosses it at most.
        begin = F.col("end") - F.col("words")
        crossed = ends.filter((begin <= F.col("rest")) & (F.col("rest") < F.col("end")))
        states.append(cut_lineage(
            crossed.select("source", "rest", "start", begin.alias("before"), "rows")
        ))
        most = states[-1].agg(F.max("rows")).first()[0] or 0
        inside = _by_source(sized, states[-1].select("source", "start")).filter(
            F.startswith("draw", F.col("start"))
        ).drop("start")
    units = inside.groupBy("source", "draw").agg(F.sum("size").alias("words"))
    units = _by_source(units, states[-1].select("source", "rest", "before", "start"))
    ordered = Window.partitionBy("source").orderBy("draw")
    ends = units.withColumn("end", F.col("before") + F.sum("words").over(ordered))
    taken = 2 * F.col("end") - F.col("words") <= 2 * F.col("rest")
    # The bare beginning stands behind all draws before it and before all that it begins.
    last = F.coalesce(F.max(F.when(taken, F.col("draw"))), F.first("start"))
    found = cut_lineage(ends.groupBy("source").agg(last.alias("last_draw")))
    forget(*states[1:])
    return found


def _by_source(rows: DataFrame, plan: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their source's one row in ``plan``."""
    named = plan.withColumnRenamed("source", "_of")
    if is_small(named, BROADCAST_ROWS):
        named = F.broadcast(named)
    return rows.join(named, rows["source"].eqNullSafe(named["_of"]), how).drop("_of")


def mixture(
    docs: DataFrame, weights: DataFrame, epochs: int = EPOCHS, total: int | None = None, seed: int = 0,
    key: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """``source, source_size, target, whole, last_draw`` of every source, as a written table.

    ``weights(source, weight)`` with one row a source. A document is taken ``whole`` times, and once
    more if its draw is not behind ``last_draw``.
    """
    sized = cut_lineage(docs.select(
        F.col(source).cast("string").alias("source"), draw(seed, key, text).alias("draw"),
        words(F.col(text)).alias("size"),
    ))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighted = cut_lineage(_by_source(sizes, weights.select("source", "weight"), "left"))
    fits = F.floor(F.try_divide("target", F.col("source_size").cast("double")))
    plan = targets(weighted, epochs, total).withColumn("whole", F.coalesce(fits, F.lit(0)))
    plan = cut_lineage(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    stops = _by_source(plan, _stops(sized, plan), "left")
    done = cut_lineage(stops.select("source", "source_size", "target", "whole", "last_draw"))
    forget(sized, weighted, plan)
    return done


def mix(
    docs: DataFrame, weights: DataFrame, epochs: int = EPOCHS, total: int | None = None, seed: int = 0,
    key: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """``docs`` with ``size, source_size, target, repeats, taken``; see ``mixture``.

    ``repeats`` is how often the mix holds the document, ``taken`` its words times that.
    """
    plan = mixture(docs, weights, epochs, total, seed, key, source, text)
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(source).cast("string").alias("source"),
        draw(seed, key, text).alias("_draw"), words(F.col(text)).alias("size"),
    )
    once_more = F.coalesce(F.col("_draw") <= F.col("last_draw"), F.lit(False)).cast("long")
    mixed = _by_source(rows, plan, "left").withColumn(
        "repeats", F.when(F.col("size") > 0, F.col("whole") + once_more).otherwise(0)
    )
    added = ("size", "source_size", "target", "repeats")
    return mixed.select(
        *[F.col("_row")[c].alias(c) for c in docs.columns if c not in (*added, "taken")],
        *added, (F.col("size") * F.col("repeats")).alias("taken"),
    )


def copies(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each as often as ``repeats`` says, numbered from 1 in ``epoch``."""
    turns = F.sequence(F.lit(1).cast("long"), F.col("repeats"))
    return mixed.filter("repeats > 0").withColumn("epoch", F.explode(turns))
