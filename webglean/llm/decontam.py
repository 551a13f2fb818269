r"""Benchmark decontamination by template canonicalisation.

Numbers, names inside a sentence and units behind a number become typed placeholders; windows of
``WINDOW`` canonical words of the documents are hash-joined with those of the benchmark items. The
matches of a document and an item on one alignment must be consistent: in the windows with changed
slots, a slot value of the item stands for one value of the document throughout; else these windows
don't count. Windows that match word for word always do. A document is contaminated if what counts
covers at least ``SHARE`` of an item's windows, so a copied question is found, and a question that
was given other numbers or names, too; a phrase in common is not enough.

Windows with fewer than ``LITERAL`` words that are no placeholders tell nothing and don't count. Items
without a window that counts match documents that have exactly their words.

Only DataFrame functions are used. Null and empty texts, on either side, match nothing. Documents
are told by ``key``: rows that share one, null too, are judged together. Items with equal canonical
words are one, with the smallest id. All columns and rows of the documents stay; a column with the
name of a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.sizing import BROADCAST_ROWS, is_small
from ..session import cut_lineage

WINDOW = 5
SHARE = 0.75
LITERAL = 2
# Units that follow a number.
UNITS = (
    "km m cm mm mi miles ft feet inches kg g mg lb lbs pounds oz l ml s sec seconds min minutes h hours "
    "days weeks months years percent dollars euros cents usd eur kmh mph degrees c f w kw kwh"
).split()
_NAME = r"\p{Lu}(?<=[\p{Ll}\p{N},;] \p{Lu})\p{Ll}+"
_UNIT = r"(?<=[0-9] ?)(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
_GAP = r"[^\p{L}\p{N}\x01\x03]+"
NAME, UNIT, NUMBER = "\u0001", "\u0003", "0"


def words(text: Column) -> Column:
    """Lower-cased words; names start with U+0001, units with U+0003, numbers with a digit."""
    plain = F.translate(text, NAME + UNIT, "  ")
    marked = F.regexp_replace(plain, _NAME, NAME + "$0")
    marked = F.when(text.rlike("[0-9]"), F.regexp_replace(marked, _UNIT, f" {UNIT}$0")).otherwise(marked)
    return F.array_remove(F.split(F.lower(marked), _GAP), "")


def _slot(word: Column) -> Column:
    return (word < "\u0004") | ((word >= "0") & (word < ":"))


def _canonical(word: Column) -> Column:
    return F.when(word < "\u0004", F.left(word, F.lit(1))).when(
        (word >= "0") & (word < ":"), NUMBER
    ).otherwise(word)


def _windows(hashes: Column, n: Column) -> Column:
    """A hash for every window; no window in shorter texts."""
    last = n - (WINDOW - 1)
    at = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.xxhash64(
        *[F.get(hashes, i + k) for k in range(WINDOW)]
    ))
    return F.when(last > 0, at).otherwise(F.array().cast("array<long>"))


def _read(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id, words, whole, windows``."""
    df = df.select(F.col(key).alias("id"), words(F.col(text).cast("string")).alias("words"))
    # No filter here and outer generators below: Spark would push a filter on these columns into
    # the scan, and work them out again there, for every window.
    df = df.withColumns({
        "hashes": F.transform("words", lambda w: F.xxhash64(_canonical(w))),
        "whole": F.when(F.size("words") > 0, F.xxhash64(F.array_join("words", " "))),
    })
    return df.withColumn("windows", _windows(F.col("hashes"), F.size("hashes")))


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    items = _read(benchmark, key, text).withColumn("print", F.sha2(F.array_join(
        F.transform("words", _canonical), " "
    ), 256))
    # Kept apart by their words where those are no window that counts.
    return cut_lineage(
        items.filter("whole is not null").groupBy("print").agg(F.min_by(F.struct("words", "whole", "windows"), "id").alias("x"), F.min("id").alias("item"))
        .select("item", "x.*")
    )


def matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", share: float = SHARE,
) -> DataFrame:
    """``id, item, covered, changed``: contaminated documents, the items, the share of an item's
    windows that they cover, and whether slot values were changed."""
    items = _items(benchmark, item_key, item_text)
    telling = items.select("item", "words", F.posexplode_outer("windows").alias("at", "window")).withColumn(
        "part", F.slice("words", F.col("at") + 1, WINDOW)
    ).filter(F.size(F.filter("part", lambda w: ~_slot(w))) >= LITERAL).drop("words")
    sizes = telling.groupBy("item").agg(F.count(F.lit(1)).alias("windows"))
    telling = cut_lineage(telling.join(sizes, "item"))
    wholes = items.join(sizes, "item", "left_anti").select("item", "whole")

    read = _read(docs, key, text)
    # A row carries the words of its window only.
    found = read.select("id", "words", F.posexplode_outer("windows").alias("place", "window")).withColumn(
        "own", F.slice("words", F.col("place") + 1, WINDOW)
    ).drop("words")
    small = is_small(telling, BROADCAST_ROWS)
    hits = found.join(F.broadcast(telling) if small else telling, "window").select(
        "id", "item", "at", "windows", (F.col("place") - F.col("at")).alias("shift"),
        F.array_distinct(F.filter(
            F.zip_with("part", "own", lambda old, new: F.when(
                _slot(old), F.struct(old.alias("old"), new.alias("new"))
            )), lambda s: s.isNotNull(),
        )).alias("slots"),
    ).withColumn("edited", F.exists("slots", lambda s: s["old"] != s["new"]))
    aligned = hits.groupBy("id", "item", "shift").agg(
        F.collect_set(F.when(~F.col("edited"), F.col("at"))).alias("same"),
        F.collect_set(F.when(F.col("edited"), F.col("at"))).alias("other"),
        F.max("windows").alias("windows"),
        # Distinct slots of an item at most: equal rows add nothing.
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("edited"), F.col("slots"))))).alias("slots"),
    ).withColumn("other", F.when(
        F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["old"]))), F.col("other")
    ).otherwise(F.array().cast("array<int>")))
    covered = aligned.groupBy("id", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.concat("same", "other"))))).alias("n"),
        F.max("windows").alias("windows"), F.max(F.size("other") > 0).alias("changed"),
    ).withColumn("covered", F.col("n") / F.col("windows")).filter(F.col("covered") >= share)
    covered = covered.select("id", "item", "covered", "changed")
    wholes = F.broadcast(wholes) if is_small(wholes, BROADCAST_ROWS) else wholes
    same = read.select("id", "whole").join(wholes, "whole").select(
        "id", "item", F.lit(1.0).alias("covered"), F.lit(False).alias("changed")
    )
    return covered.union(same)


def flag(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", share: float = SHARE,
) -> DataFrame:
    """Add ``contaminated``, ``n_items``, ``item_id`` (the smallest), ``covered`` (the largest) and
    ``changed``; the last three are null for clean documents."""
    found = matches(docs, benchmark, key, text, item_key, item_text, share).groupBy("id").agg(
        F.count_distinct("item").alias("n_items"), F.min("item").alias("item_id"),
        F.max("covered").alias("covered"), F.max("changed").alias("changed"),
    )
    # Rows travel in a struct, so no name of theirs can clash.
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.struct("*").alias("row"))
    joined = rows.join(found, rows["key"].eqNullSafe(found["id"]), "left")
    new = {
        "contaminated": F.col("n_items").isNotNull(), "n_items": F.coalesce("n_items", F.lit(0)),
        "item_id": F.col("item_id"), "covered": F.col("covered"), "changed": F.col("changed"),
    }
    kept = {c: F.col("row").getField(c) for c in docs.columns if c.lower() not in new}
    return joined.select(*[column.alias(c) for c, column in {**kept, **new}.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """Documents that no item was found in."""
    bad = matches(docs, benchmark, key, **names).select(F.col("id").alias("_id")).distinct()
    return docs.join(bad, docs[key].eqNullSafe(bad["_id"]), "left_anti")
